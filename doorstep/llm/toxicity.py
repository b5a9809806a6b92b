"""Toxicity by a factorization machine over hashed terms.

A text's terms are its words (runs of letters, lower case) and their first four and five
letters, each counted once and hashed to ``BUCKETS`` places.  The machine's score is

    sigmoid(b + sum w_i + sum over pairs <v_i, v_j>)

so that a pair of terms, such as an insult next to the mention of a group, can weigh
more, or less, than the two alone.  The pair sum is computed as
``(|sum v|^2 - sum |v|^2) / 2``, which is linear in the number of terms.

Learning uses a bounded sample: the ``TRAIN_ROWS`` labelled documents with the smallest
hash of their id.  Terms are counted over the sample by Spark; those that
``LEAST_DOCUMENTS`` of its documents hold are kept, whatever their labels, since a term that
tells nothing alone may tell much in a pair.  The machine is fitted to the sample's kept
terms.  Scoring reads every whole text.

Null and empty texts have no terms and get the machine's constant.  Repeated rows are
scored alike, each for itself.  An empty table gives an empty result; without any label
of both kinds every score is the smoothed share of the label 1, or 0.0 without labels.
Labels other than 0 and 1, and null ones, are not used; of several labels of a document
the highest counts.  Other columns of the inputs are ignored.
"""

from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from .shared import stored, widened
from .text import buffers, fold, forget, numbered, one_text, release, whole_rows

BUCKETS = 1 << 22
#: Bound of the sample of labelled rows that the machine is fitted to.
TRAIN_ROWS = 20_000
#: The least number of sample documents that hold a kept term.
LEAST_DOCUMENTS = 3
#: Strength, in standard deviations of its count, from which a term is trusted by itself.
STRONG = 4.0
FACTORS = 6
EPOCHS = 15
THRESHOLD = 0.3

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Machine:
    terms: np.ndarray  # buckets, ascending
    bias: float
    weights: np.ndarray
    factors: np.ndarray


def _terms_of(word):
    yield xxhash.xxh64_intdigest(word, 1) % BUCKETS
    text = word.decode("utf-8", "replace")
    for n in (4, 5):
        if len(text) > n:
            yield xxhash.xxh64_intdigest(text[:n].encode(), n) % BUCKETS


def document_terms(data, offsets, kept=None):
    """Pairs (text, term), distinct and ordered by text.

    Terms are buckets, or their places in ``kept`` where that is given; others are left
    out then.
    """
    data = _LOWER[data]
    # the Latin-1 capitals C3 80 - C3 9E; C3 97 is a sign
    second = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] < 0x9F) & (data[1:] != 0x97)) + 1
    data[second] += 32
    solid = _LETTER[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first, last = solid.copy(), solid
    if len(data):
        first[1:] &= ~solid[:-1] | edge[1:-1]
        last = solid.copy()
        last[:-1] &= ~solid[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    codes, words = numbered(data, starts, ends)
    words = words.to_pylist()
    table = np.full((len(words), 3), -1, np.int64)
    for i, word in enumerate(words):
        for j, term in enumerate(_terms_of(word)):
            table[i, j] = term
    if kept is not None:
        place = np.searchsorted(kept, table)
        place[place == len(kept)] = 0
        known = kept[place] == table if len(kept) else np.zeros(table.shape, bool)
        table = np.where(known, place, -1)
    # a text's distinct words first, then their terms
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets)))
    useful = (table >= 0).any(axis=1)[codes]
    pairs = np.unique(text[useful] * max(len(words), 1) + codes[useful])
    text, word = np.divmod(pairs, max(len(words), 1))
    term = table[word]
    text = np.repeat(text, 3)[term.ravel() >= 0]
    term = term.ravel()[term.ravel() >= 0]
    size = BUCKETS if kept is None else max(len(kept), 1)
    return np.divmod(np.unique(text * size + term), size)


def _count_terms(batches):
    forget()
    for batch in whole_rows(batches, 0):
        found, both = np.unique(document_terms(*buffers(batch.column(0)))[1], return_counts=True)
        yield pa.record_batch(
            [pa.array(found), pa.array(both.astype(np.int64))], names=["term", "both"]
        )


def _sample_terms(kept):
    def run(batches):
        forget()
        for batch in whole_rows(batches, 0):
            data, offsets = buffers(batch.column(0))
            text, term = document_terms(data, offsets, kept)
            ends = np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.record_batch(
                [pa.ListArray.from_arrays(ends, pa.array(term.astype(np.int32))), batch.column(1)],
                names=["terms", "toxic"],
            )

    return run


def fit(docs, labels, usable=None):
    """Fit a machine to labelled rows.  ``usable`` is a condition on the labels' rows."""
    if usable is not None:
        labels = labels.where(usable)
    sample = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(TRAIN_ROWS)
    )
    # at most TRAIN_ROWS rows of an id and a label: a bound for the broadcast, and of one
    # text an id for the driver
    held = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    rows = stored(one_text(held, "toxic").select("text", "toxic"), "toxic-sample")
    total, ones = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    share = (ones + 0.5) / (total + 1.0)
    counts = rows.mapInArrow(_count_terms, "term long, both long").groupBy("term")
    kept = counts.agg(F.sum("both").alias("both")).where(F.col("both") >= LEAST_DOCUMENTS)
    # BUCKETS terms at most
    terms = np.sort(kept.select("term").toArrow()["term"].to_numpy())
    if not total or ones in (0, total) or not len(terms):
        bias = float(np.log(share / (1 - share))) if total else -np.inf
        return Machine(terms[:0], bias, np.zeros(0), np.zeros((0, FACTORS)))
    found = rows.mapInArrow(_sample_terms(terms), "terms array<int>, toxic int").toArrow()
    machine = _fit(found, terms, share)
    del found
    release()  # the driver lives on, and other stages follow
    return machine


def _by_content(lists, label):
    """Places in the order of the lists' bytes, then labels; whole bytes only where they begin alike."""

    def head(i):
        return lists[i][:64].tobytes()

    alike = groupby(sorted(range(len(lists)), key=head), head)
    return [i for _, some in alike for i in sorted(some, key=lambda i: (lists[i].tobytes(), label[i]))]


def _fit(found, terms, share):
    """Adagrad on the logistic loss, by mini-batches in an order fixed by content.

    The linear weight of a term learns in proportion to its ``trust``, which is 1 from
    ``STRONG`` standard deviations on; a term without strength of its own keeps its part
    in pairs.  Otherwise the many weak terms together would learn the sample by heart.
    """
    label = found["toxic"].to_numpy().astype(np.float64)
    lists = []
    for column in found["terms"].chunks:  # as they came: the driver holds them once
        every, edges = column.flatten().to_numpy(), np.r_[0, np.cumsum(column.value_lengths().to_numpy())]
        lists += [every[a:b] for a, b in zip(edges, edges[1:])]
    order = _by_content(lists, label)
    rng = np.random.default_rng(7)
    n = len(terms)
    size = sum(map(len, lists))
    both, ones = np.zeros(n, np.int64), np.zeros(n)
    for some, y in zip(lists, label):  # a text has a term once
        both[some] += 1
        ones[some] += y
    strength = np.abs(ones - share * both) / np.sqrt(share * both + 0.5)
    trust = np.clip((strength / STRONG) ** 2, 0.1, 1)
    lists, label = [lists[i] for i in order], label[order]
    # long texts have many pairs: smaller steps
    slow = min(1, 30 / max(size / max(len(lists), 1), 1))
    place_of = np.zeros(n, np.int64)
    w, v = np.zeros(n), rng.normal(0, 0.01, (n, FACTORS))
    bias, seen_b, seen_w, seen_v = np.log(share / (1 - share)), 1.0, np.ones(n), np.ones((n, FACTORS))
    for _ in range(EPOCHS):
        turn = rng.permutation(len(lists))
        for at in range(0, len(turn), 128):
            rows = turn[at : at + 128]
            flat = np.concatenate([lists[r] for r in rows])
            row = np.repeat(np.arange(len(rows)), [len(lists[r]) for r in rows])
            here = np.zeros(n, bool)
            here[flat] = True
            active = np.flatnonzero(here)
            place_of[active] = np.arange(len(active))
            place = place_of[flat]
            va, size = v[active], len(active)
            vf = v[flat]
            sums = np.stack([np.bincount(row, vf[:, k], len(rows)) for k in range(FACTORS)], 1)
            squares = np.bincount(row, (vf**2).sum(1), len(rows))
            z = bias + np.bincount(row, (trust * w)[flat], len(rows)) + ((sums**2).sum(1) - squares) / 2
            miss = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - label[rows]
            gb = miss.sum() / len(rows)
            alone = np.bincount(place, miss[row], size)
            gw = trust[active] * alone / len(rows) * 8 + 1e-4 * w[active]
            pulls = (miss[:, None] * sums)[row]
            pulls = np.stack([np.bincount(place, pulls[:, k], size) for k in range(FACTORS)], 1)
            gv = (pulls - va * alone[:, None]) / len(rows) * 8 + 1e-2 * va
            seen_b += gb**2
            seen_w[active] += gw**2
            seen_v[active] += gv**2
            bias -= 0.1 * gb / np.sqrt(seen_b)
            w[active] -= 0.6 * gw / np.sqrt(seen_w[active])
            v[active] -= 0.05 * slow * gv / np.sqrt(seen_v[active])
    return Machine(terms, float(bias), trust * w, v)


def _scores(machine, data, offsets):
    n = len(offsets) - 1
    text, term = document_terms(data, offsets, machine.terms)
    v = machine.factors[term]
    linear = np.bincount(text, machine.weights[term], n)
    pairs = np.zeros(n)
    for k in range(machine.factors.shape[1]):
        pairs += np.bincount(text, v[:, k], n) ** 2 - np.bincount(text, v[:, k] ** 2, n)
    return 1 / (1 + np.exp(-np.clip(machine.bias + linear + pairs / 2, -700, 30)))


def score(docs, machine, column="score"):
    """``docs`` with the score of each whole text appended as ``column``, replacing one of that name."""
    docs, schema = widened(docs, **{column: "double"})
    place = docs.columns.index("text")

    def run(batches):
        forget()
        for batch in whole_rows(batches, place):
            s = pa.array(_scores(machine, *buffers(batch.column(place))))
            yield pa.RecordBatch.from_arrays([*batch.columns, s], names=[*batch.schema.names, column])

    return docs.mapInArrow(run, schema)


def op10_toxicity(spark, sf_dir):
    """The contract's rows: learns from folds other than 2, scores every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    machine = fit(docs, labels, fold("doc_id", 4) != 2)
    return score(docs, machine).select(
        "doc_id",
        (fold("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
