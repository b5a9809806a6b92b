"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built from labelled text.  A text is parsed
against it: from where the last phrase ended, the longest match anywhere in the
language's sample is the next phrase (one unknown byte is a phrase too).  The language
whose automaton needs the fewest phrases, weighted by ``log2`` of the length of its
sample, wins; this estimates the bits per byte of coding the text with the sample.

Texts are normalised bytes: lower case, everything that is no letter a single blank (code
points outside ASCII are letters by their category, with the marks that belong to them).
They are parsed whole, in windows of ``WINDOW`` bytes that each begin a phrase, so that
many windows advance together, byte by byte, through one numpy table that holds all
automata.

Learning uses a bounded sample: per language ``SAMPLE_DOCS`` documents at most and
``SAMPLE_BYTES`` bytes in all, of whole normalised texts.  Texts of up to ``EVEN_BYTES``
come first, by the smallest hash, then longer ones by their length.  Only where a text
alone is longer than the whole sample its middle has to do.

A null text, and one without a letter, is ``und`` with score 0.0; so is every text when
there is nothing to learn from.  Ties go to the language first in order.  The score is
``1 - best / (best + second)``, 1.0 where only one language was learned; identical rows
get identical results.  Extra columns are ignored.
"""

import functools
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from .shared import widened
from .text import CACHES, LOWER, buffers, fold, forget, whole_rows

#: Bound of the labelled sample, per language.
SAMPLE_DOCS = 48
SAMPLE_BYTES = 24_576
#: Texts up to this length are sampled by their hash alone.
EVEN_BYTES = 1_536
WINDOW = 512

_BLANK = 32
_FORM = LOWER.copy()
_FORM[[b for b in range(128) if not 97 <= LOWER[b] <= 122]] = _BLANK


@functools.cache
def _letters():
    """Per code point 2 for a letter, 1 for a mark, else 0."""
    kinds = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        kinds[c] = {"L": 2, "M": 1}.get(unicodedata.category(chr(c))[0], 0)
    return kinds


def without_signs(data, offsets):
    """(the bytes with signs outside ASCII blanked, per text whether it has a letter)."""
    ascii_letters = (LOWER[data] >= 97) & (LOWER[data] <= 122)
    letter = ascii_letters
    if len(data) and data.max() >= 128:
        data = data.copy()
        lead = np.flatnonzero(data >= 0xC0)
        size = 2 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0).astype(np.int64)
        point = (data[lead] & (0xFF >> (size + 1))).astype(np.int64)
        for k in range(1, 4):
            on = size > k
            point[on] = point[on] << 6 | (data[np.minimum(lead[on] + k, len(data) - 1)] & 0x3F)
        kind = _letters()[np.minimum(point, 0x10FFFF)]
        letter[lead[kind == 2]] = True
        for k in range(4):
            data[np.minimum(lead[(kind == 0) & (size > k)] + k, len(data) - 1)] = _BLANK
    before = np.r_[0, np.cumsum(letter)][offsets]
    return data, np.diff(before) > 0


def normalised(data, offsets):
    """Lower-case letters and single blanks, with the offsets that belong to them.

    Blanks go where a text begins, whatever stands before it.
    """
    form = _FORM[data]
    second = np.flatnonzero((form[:-1] == 0xC3) & (form[1:] < 0x9F) & (form[1:] != 0x97)) + 1
    form[second] += 32
    keep = form != _BLANK
    if len(form):
        keep[1:] |= keep[:-1]
        first = offsets[:-1][np.diff(offsets) > 0]
        keep[first] = form[first] != _BLANK
    return form[keep], np.r_[0, np.cumsum(keep)][offsets]


def automaton(sample):
    """Suffix automaton of a byte string: a list of transitions per state."""
    links, lengths, steps = [-1], [0], [{}]
    last = 0
    for c in sample:
        new = len(steps)
        lengths.append(lengths[last] + 1)
        steps.append({})
        links.append(0)
        p = last
        while p >= 0 and c not in steps[p]:
            steps[p][c] = new
            p = links[p]
        if p >= 0:
            q = steps[p][c]
            if lengths[q] == lengths[p] + 1:
                links[new] = q
            else:
                copy = len(steps)
                lengths.append(lengths[p] + 1)
                steps.append(dict(steps[q]))
                links.append(links[q])
                while p >= 0 and steps[p].get(c) == q:
                    steps[p][c] = copy
                    p = links[p]
                links[q] = links[new] = copy
        last = new
    return steps


class Parser:
    """All languages' automata in one table.

    An entry is twice the place of the next state's row plus one if a phrase begins at
    this byte; a state without the byte leads to where the root goes with it.
    """

    def __init__(self, samples):
        self.languages = sorted(samples)
        texts = [samples[x] for x in self.languages]
        known = sorted(set().union(*texts))
        self.symbol = np.zeros(256, np.int32)
        self.symbol[known] = np.arange(1, len(known) + 1)
        width = len(known) + 1
        tables, self.roots, base = [], [], 0
        for text in texts:
            steps = automaton(text)
            at_root = np.full(width, 2 * base + 1, np.int64)
            for c, s in steps[0].items():
                at_root[self.symbol[c]] = 2 * (base + s * width) + 1
            table = np.tile(at_root, (len(steps), 1))
            for i, known_steps in enumerate(steps[1:], 1):
                for c, s in known_steps.items():
                    table[i, self.symbol[c]] = 2 * (base + s * width)
            tables.append(table.astype(np.int32).ravel())
            self.roots.append(base)
            base += table.size
        self.table = np.concatenate(tables) if tables else np.zeros(0, np.int32)
        self.bits = np.array([np.log2(max(len(t), 2)) for t in texts])

    def phrases(self, data, offsets):
        """Phrases per text and language; ``data`` is normalised."""
        lengths = np.diff(offsets)
        windows = -(-lengths // WINDOW)
        text = np.repeat(np.arange(len(lengths)), windows)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows)
        start = offsets[text] + nth * WINDOW
        size = np.minimum(offsets[text + 1] - start, WINDOW)
        order = np.argsort(-size, kind="stable")
        start, size, text = start[order], size[order], text[order]
        symbols = self.symbol[data]
        k = len(self.roots)
        state = np.repeat(np.array(self.roots, np.int32)[:, None], len(text), 1)
        count = np.zeros((k, len(text)), np.int32)
        live = np.searchsorted(-size, -np.arange(WINDOW), "left")
        for step in range(int(size[0]) if len(size) else 0):
            n = live[step]
            entry = self.table[state[:, :n] + symbols[start[:n] + step]]
            count[:, :n] += entry & 1
            state[:, :n] = entry >> 1
        return np.stack([np.bincount(text, count[i], len(lengths)) for i in range(k)], 1)

    def identify(self, data, offsets):
        """(language, score, bits per byte) of each text with a letter, else und."""
        data, lettered = without_signs(data, offsets)
        data, offsets = normalised(data, offsets)
        n = len(offsets) - 1
        if not self.languages or not n:
            return ["und"] * n, np.zeros(n), np.zeros(n)
        size = np.diff(offsets)
        cost = self.phrases(data, offsets) * self.bits / np.maximum(size, 1)[:, None]
        best = cost.argmin(1)
        ranked = np.sort(cost, 1)
        none = ~lettered
        score = np.ones(n)
        if cost.shape[1] > 1:
            score = 1 - ranked[:, 0] / np.maximum(ranked[:, 0] + ranked[:, 1], 1e-300)
        names = ["und" if x else self.languages[b] for x, b in zip(none, best)]
        return names, np.where(none, 0.0, score), np.where(none, 0.0, ranked[:, 0])


def _sample_of(text):
    """A whole text, normalised; of one longer than a sample, its middle."""
    if len(text) > 4 * SAMPLE_BYTES:
        middle = len(text) // 2 - 2 * SAMPLE_BYTES
        # whole code points
        text = text[middle : middle + 4 * SAMPLE_BYTES].decode("utf-8", "ignore").encode()
    data, ends = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    form = normalised(without_signs(data, ends)[0], ends)[0]
    return form[max(len(form) - SAMPLE_BYTES, 0) // 2 :][:SAMPLE_BYTES].tobytes()


def _smallest(batches):
    """Of each language the SAMPLE_DOCS first documents of a task, with their samples."""
    held = {}
    for batch in batches:
        sizes = np.maximum(np.diff(buffers(batch.column(0))[1]), EVEN_BYTES)
        hashes, languages = batch.column(1).to_numpy(), batch.column(2).to_pylist()
        for i in np.lexsort((hashes, sizes)):
            best, at = held.setdefault(languages[i], []), (int(sizes[i]), int(hashes[i]))
            if len(best) < SAMPLE_DOCS or at < best[-1][:2]:
                best.append((*at, _sample_of(batch.column(0)[int(i)].as_py().encode())))
                best.sort()
                del best[SAMPLE_DOCS:]
    rows = [(x, *r) for x, best in held.items() for r in best]
    yield pa.record_batch(
        [
            pa.array([r[0] for r in rows], pa.string()),
            pa.array([r[1] for r in rows], pa.int64()),
            pa.array([r[2] for r in rows], pa.int64()),
            pa.array([r[3] for r in rows], pa.binary()),
        ],
        names=["lang", "size", "h", "sample"],
    )


def fit(docs, usable=None):
    """The languages' samples: ``lang`` to bytes, bounded per language."""
    rows = docs.where(F.col("lang").isNotNull() & (F.col("lang") != "und") & F.col("text").rlike(r"\p{L}"))
    if usable is not None:
        rows = rows.where(usable)
    held = rows.select("text", F.xxhash64("doc_id", "text").alias("h"), "lang").mapInArrow(
        _smallest, "lang string, size long, h long, sample binary"
    )
    order = Window.partitionBy("lang").orderBy("size", "h", "sample")
    best = held.withColumn("n", F.row_number().over(order)).where(F.col("n") <= SAMPLE_DOCS)
    samples = {}
    for r in best.orderBy("lang", "n").collect():
        known = samples.get(r.lang, b"")
        if not known or len(known) + len(r.sample) <= SAMPLE_BYTES:
            samples[r.lang] = known + bytes(r.sample) + b" "
    return {x: s for x, s in samples.items() if s.strip()}


_parsers = CACHES.setdefault("language", {})


def _parser(samples):
    key = tuple(sorted(samples.items()))
    if key not in _parsers:
        _parsers.clear()
        _parsers[key] = Parser(samples)
    return _parsers[key]


def identify(docs, samples, prefix=""):
    """``docs`` with ``lang_pred``, ``score`` and ``bits`` (per byte) appended.

    The names begin with ``prefix``; columns of these names are replaced.
    """
    kinds = {f"{prefix}lang_pred": "string", f"{prefix}score": "double", f"{prefix}bits": "double"}
    docs, schema = widened(docs, **kinds)
    place = docs.columns.index("text")

    def run(batches):
        forget("language")
        parser = _parser(samples)
        for batch in whole_rows(batches, place):
            names, score, bits = parser.identify(*buffers(batch.column(place)))
            more = [pa.array(names, pa.string()), pa.array(score), pa.array(bits)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *more],
                names=[*batch.schema.names, *kinds],
            )

    return docs.mapInArrow(run, schema)


def op3_language(spark, sf_dir):
    """The contract's rows: learns from folds other than 2, predicts every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    samples = fit(docs, fold("doc_id", 4) != 2)
    return identify(docs.select("doc_id", "text"), samples).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score"
    )
