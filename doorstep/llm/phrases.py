"""Phrases that keep together, mined by Rabin-Karp fingerprints.

Texts are lowered (A-Z), split into pieces at ``.,;:!?`` and line ends, and pieces into
words at blanks and tabs.  A phrase of up to ``LONGEST`` words of a piece has two
fingerprints: words are numbers by a polynomial over their bytes, and prefix polynomials
over a part's words give those of all its n-grams at once.  Language and length are mixed in.

**Counting.**  Lengths are counted one after another.  A task adds up equal fingerprints of
a part of its text, the shuffle those of all tasks; along go the sum of the second
fingerprints, by a prime, and the least digest of a text in which the phrase occurs, the
pointer.  An n-gram is looked at only if both (n-1)-grams inside it are frequent, which it
needs to be frequent itself.  Tasks know the frequent ones by a bit table
(``bittable``) of one size whatever the corpus; a table that fills lets more pass, and no
result changes.

**Texts.**  Only frequent phrases become text.  Their pointers fall on the few texts of the
smallest digests; these are read again and the phrases found in them by their fingerprint.
A phrase is accepted if its own second fingerprint, as often as it was counted, makes the
sum.  If not, phrases met in the first fingerprint; they are counted again by their text.
(Phrases equal in both, 64 and 31 bits, would pass unseen.)

Scores are exact: products are decimals of 38 digits.

A null text has no words; a null language is ``und``.  Equal rows count as often as they
stand there.  Ties of the cut go to the shorter first part, those of the ranking to the
phrase that is smaller bytewise.  No rows: no result.  Other columns are ignored.
"""

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from . import bittable
from .bittable import BitTable, mixed
from .shared import stored
from .text import LOWER, buffers, whole_rows

LONGEST = 5
LEAST = 100
FIRST = 2000
#: Bytes of text handled at once.
PART_BYTES = 2 << 20

_CUT = np.zeros(256, bool)
_CUT[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_SOLID = ~_CUT
_SOLID[[0x20, 0x09]] = False

# Odd bases: bytes in words, words in phrases, for either fingerprint.
_BYTES = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)]
_WORDS = [np.uint64(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
#: Second fingerprints are added up by this prime.
_PRIME = (1 << 31) - 1


@functools.lru_cache(8)
def _powers_of(base, n):
    return np.cumprod(np.r_[np.uint64(1), np.full(n - 1, base, np.uint64)])


def _powers(base, n):
    return _powers_of(base, 1 << max(int(n), 2).bit_length())[:n]


def _inverse(base):
    return np.uint64(pow(int(base), -1, 1 << 64))


class Words:
    """The words of a part's texts, and the fingerprints of their phrases."""

    def __init__(self, data, offsets, languages):
        data = LOWER[data]
        solid, n = _SOLID[data], len(data)
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        first, last = solid.copy(), solid.copy()
        first[1:] &= ~solid[:-1] | edge[1:-1]
        last[:-1] &= ~solid[1:] | edge[1:-1]
        self.data = data
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.edges = np.searchsorted(self.starts, offsets)
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(self.edges))
        # words of a piece share this number, others do not
        self.piece = np.cumsum(_CUT[data])[self.starts] + self.text
        self.seed = np.array([xxhash.xxh64_intdigest(x.encode(), 5) for x in languages], np.uint64)
        size = self.ends - self.starts
        begin = np.cumsum(size) - size
        held = data[solid].astype(np.uint64) + np.uint64(1)
        nth = np.arange(len(held)) - np.repeat(begin, size)
        self.sums = []
        for byte, word in zip(_BYTES, _WORDS):
            if len(size):
                h = np.add.reduceat(held * _powers(byte, int(size.max()))[nth], begin)
                h = mixed(h + size.astype(np.uint64))
            else:
                h = np.zeros(0, np.uint64)
            self.sums.append(np.r_[np.uint64(0), np.cumsum(h * _powers(word, len(h)))])

    def places(self, size):
        """The words that begin a phrase of ``size`` words."""
        n = len(self.starts) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.piece[:n] == self.piece[size - 1 :])

    def fingerprints(self, places, size, which, bits=64):
        sums = self.sums[which]
        h = (sums[places + size] - sums[places]) * _powers(_inverse(_WORDS[which]), len(self.starts))[places]
        h = mixed(h + self.seed[self.text[places]] + np.uint64(size))
        return h >> np.uint64(64 - bits) if bits < 64 else h

    def checks(self, places, size):
        return (self.fingerprints(places, size, 1) % np.uint64(_PRIME)).astype(np.int64)

    def phrase(self, place, size):
        found = [self.data[self.starts[i] : self.ends[i]].tobytes() for i in range(place, place + size)]
        return b" ".join(found).decode("utf-8", "replace")


# --- counting ------------------------------------------------------------------------

_SEEN = "lang string, key long, n long, doc long, total long"


def _digests(data, offsets, languages):
    """32 bits of each text and language: several texts may share one, and all are read then."""
    raw = data.tobytes()
    parts = zip(offsets, offsets[1:], languages)
    return np.array([xxhash.xxh32_intdigest(x.encode() + b"\0" + raw[a:b], 7) for a, b, x in parts], np.int64)


def _read(batches):
    """(words, languages, digests of the texts) of the parts of (text, lang)."""
    for part in whole_rows(batches, 0, PART_BYTES):
        data, offsets = buffers(part.column(0))
        languages = part.column(1).to_pylist()
        yield Words(data, offsets, languages), languages, _digests(data, offsets, languages)


def _signed(x):
    return pa.array(x.view(np.int64))


def _candidates(words, size, table, bits):
    """The phrases of a length whose own parts of one word less are all in the table."""
    places = words.places(size)
    if table is None:
        return places
    inner = np.zeros(len(words.starts) + 1, bool)
    shorter = words.places(size - 1)
    inner[shorter] = table.has(words.fingerprints(shorter, size - 1, 0, bits))
    return places[inner[places] & inner[places + 1]]


def _counted(size, shipped, bits):
    def run(batches):
        table = shipped and BitTable(shipped)
        for words, languages, docs in _read(batches):
            places = _candidates(words, size, table, bits)
            key = words.fingerprints(places, size, 0, bits)
            order = np.argsort(key, kind="stable")
            key, places = key[order], places[order]
            begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
            total = n = least = np.zeros(0, np.int64)
            if len(begin):
                n = np.diff(np.r_[begin, len(key)])
                # sums of fewer than 2**32 numbers of 31 bits
                total = np.add.reduceat(words.checks(places, size), begin) % _PRIME
                least = np.minimum.reduceat(docs[words.text[places]], begin)
            found = [
                pa.nulls(len(begin), pa.string()), _signed(key[begin]), pa.array(n.astype(np.int64)),
                pa.array(least), pa.array(total),
            ]
            yield pa.RecordBatch.from_arrays(found, names=_SEEN_NAMES)
            if size == 1:
                # the number of words of each language
                names = sorted(set(languages))
                at = {x: i for i, x in enumerate(names)}
                place = np.array([at[x] for x in languages], np.int64)
                count = np.bincount(place, np.diff(words.edges), len(names)).astype(np.int64)
                zero = pa.array(np.zeros(len(names), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), zero, pa.array(count), zero, zero], names=_SEEN_NAMES
                )

    return run


_SEEN_NAMES = ["lang", "key", "n", "doc", "total"]


def _frequent(texts, size, table, least, bits):
    """The frequent fingerprints of a length; for words also the languages' totals."""
    seen = texts.mapInArrow(_counted(size, table, bits), _SEEN)
    by = ["lang", "key"] if size == 1 else ["key"]
    # a part's total is below 2**31, so their sum stays within a long
    sums = seen.groupBy(*by).agg(
        F.sum("n").alias("n"), F.min("doc").alias("doc"), F.sum("total").alias("total")
    )
    kept = F.col("n") >= least
    return stored(sums.where(kept | F.col("lang").isNotNull() if size == 1 else kept), f"phrases-{size}")


# --- texts of the frequent ones ---------------------------------------------------------

_PHRASE = "key long, size int, lang string, phrase string, check long"


def _pointed(shipped):
    """The texts whose digest is in the table, once in a task."""

    def run(batches):
        table, met = BitTable(shipped), set()
        for part in whole_rows(batches, 0, PART_BYTES):
            data, offsets = buffers(part.column(0))
            docs = _digests(data, offsets, part.column(1).to_pylist())
            keep, raw = table.has(docs.view(np.uint64)), data.tobytes()
            for i in np.flatnonzero(keep):
                of = docs[i], xxhash.xxh64_intdigest(raw[offsets[i] : offsets[i + 1]])
                keep[i] = of not in met
                met.add(of)
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs), part.column(0), part.column(1)], names=["doc", "text", "lang"]
            ).filter(pa.array(keep))

    return run


def _found(bits):
    """The phrases asked for in each text: (text, lang, keys, sizes) to _PHRASE."""

    def run(batches):
        for part in whole_rows(batches, 0, PART_BYTES):
            data, offsets = buffers(part.column(0))
            languages = part.column(1).to_pylist()
            words = Words(data, offsets, languages)
            wanted = part.column(2).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            sizes = part.column(3).flatten().to_numpy(zero_copy_only=False)
            rows = []
            for size in np.unique(sizes):
                keys = np.unique(wanted[sizes == size])
                places = words.places(size)
                own = words.fingerprints(places, size, 0, bits)
                at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                hit = keys[at] == own
                own, places = own[hit], places[hit]
                own, first = np.unique(own, return_index=True)
                places = places[first]
                rows += [
                    (int(k), int(size), languages[words.text[p]], words.phrase(p, size), int(c))
                    for k, p, c in zip(own.view(np.int64), places, words.checks(places, size))
                ]
            yield _phrase_batch(rows)

    return run


def _phrase_batch(rows, more=()):
    columns = list(zip(*rows)) or [()] * (5 + len(more))
    kinds = [pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), *[k for _, k in more]]
    names = ["key", "size", "lang", "phrase", "check", *[n for n, _ in more]]
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _recounted(shipped, longest, bits):
    """All phrases whose fingerprint is in the table, by their text, with counts."""

    def run(batches):
        table = BitTable(shipped)
        for words, languages, _ in _read(batches):
            rows = []
            for size in range(1, longest + 1):
                places = words.places(size)
                keys = words.fingerprints(places, size, 0, bits)
                hit = table.has(keys)
                tally = {}
                for k, p in zip(keys[hit].view(np.int64).tolist(), places[hit].tolist()):
                    of = (k, size, languages[words.text[p]], words.phrase(p, size), 0)
                    tally[of] = tally.get(of, 0) + 1
                rows += [(*of, n) for of, n in tally.items()]
            yield _phrase_batch(rows, [("n", pa.int64())])

    return run


def frequent_phrases(docs, least=LEAST, longest=LONGEST, bits=64):
    """((lang, size, phrase, a) of the phrases found ``least`` times or more, (lang, n)).

    ``bits`` of the first fingerprint are used; fewer make phrases meet, for tests.
    """
    texts = docs.select(
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
    )
    table, held, totals = None, None, None
    for size in range(1, longest + 1):
        rows = _frequent(texts, size, table, least, bits)
        if size == 1:
            totals = rows.where("lang IS NOT NULL").select("lang", "n")
            rows = rows.where("lang IS NULL")
        table = bittable.shipped(rows.select("key"))
        rows = rows.select("key", F.lit(size).alias("size"), "n", "doc", "total")
        held = rows if held is None else held.unionAll(rows)

    wanted = held.groupBy("doc").agg(F.collect_list("key").alias("keys"), F.collect_list("size").alias("sizes"))
    pointers = bittable.shipped(held.select("doc"))
    # equal texts once; others that share a digest all stay
    some = texts.mapInArrow(_pointed(pointers), "doc long, text string, lang string").distinct()
    some = some.join(wanted, "doc").select("text", "lang", "keys", "sizes")
    phrases = some.mapInArrow(_found(bits), _PHRASE).distinct()
    of = held.select(F.col("key").alias("_key"), F.col("size").alias("_size"), "n", "total")
    same = (F.col("key") == F.col("_key")) & (F.col("size") == F.col("_size"))
    # the product is taken by the prime, so that it stays within a long
    right = (F.col("n") % _PRIME) * F.col("check") % _PRIME == F.col("total") % _PRIME
    found = phrases.join(of, same & right).select("key", "lang", "size", "phrase", F.col("n").alias("a"))
    found = stored(found, "phrases-found")
    met = stored(of.select("_key", "_size").join(found, same, "left_anti"), "phrases-met")
    found = found.select("lang", "size", "phrase", "a")
    if not met.isEmpty():
        counts = texts.mapInArrow(_recounted(bittable.shipped(met.select("_key")), longest, bits), f"{_PHRASE}, n long")
        counts = counts.groupBy("key", "lang", "size", "phrase").agg(F.sum("n").alias("a")).where(F.col("a") >= least)
        again = counts.join(met, same)
        found = found.unionByName(again.select("lang", "size", "phrase", "a"))
    return stored(found, "phrases-frequent"), stored(totals, "phrases-totals")


# --- scores --------------------------------------------------------------------------


def _words_of(first, size):
    return F.array_join(F.slice("words", first, size), " ")


def score():
    """floor(1000 a n / (l r)) of columns of these names, exact beyond 64 bits."""
    a, n, l, r = (f"cast({c} AS decimal(19, 0))" for c in "anlr")
    return F.expr(f"cast((1000 * {a} * {n}) div ({l} * {r}) AS long)")


def collocations(docs, least=LEAST, longest=LONGEST, first=FIRST, bits=64):
    """Each language's ``first`` phrases: lang, rank, phrase, a, l, r, n, score.

    Candidates have two words or more.  The lowest-scoring cut counts, and a phrase that
    stands in a longer candidate each time it occurs is dropped.
    """
    known, totals = frequent_phrases(docs, least, longest, bits)
    known = known.withColumn("words", F.split("phrase", " "))
    candidates = known.where("size > 1")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "k", _words_of(F.lit(1), F.col("k")).alias("head"),
        _words_of(F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"),
    )
    for part, count in (("head", "l"), ("tail", "r")):
        counts = known.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("a").alias(count))
        cuts = cuts.join(counts, (F.col("lang") == F.col("_lang")) & (F.col(part) == F.col("_part")))
        cuts = cuts.drop("_lang", "_part")
    cuts = cuts.join(totals.withColumnRenamed("lang", "_lang"), F.col("lang") == F.col("_lang"))
    best = cuts.withColumn("score", score()).groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    inner = candidates.where("size > 2").withColumn(
        "m", F.explode(F.sequence(F.lit(2), F.col("size") - 1))
    )
    inner = inner.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)))
    inner = inner.groupBy(F.col("lang").alias("_lang"), _words_of(F.col("at"), F.col("m")).alias("_part")).agg(
        F.max("a").alias("_most")
    )
    inside = (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_part")) & (F.col("_most") >= F.col("a"))
    kept = best.join(inner, inside, "left_anti").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("int"), "phrase", "a", "l", "r", "n", "score")


def op13_phrases(spark, sf_dir):
    """The contract's rows over all documents."""
    found = collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.withColumn("rank", F.col("rank").cast("long"))
