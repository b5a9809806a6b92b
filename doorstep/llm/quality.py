"""Quality rules: gradient-boosted trees over document statistics.

Statistics of whole texts are taken with numpy, many texts at once.  A text fails the
base rules if it has fewer than 50 words or if more than half of its words stand in
three-word windows that occur twice or more.  What passes them is judged by boosted
trees, fitted here: logistic loss, histogram splits, and monotonic constraints, so that
more symbols, repeated lines or repeated words can never raise a text's score.  Trees
are flattened into node arrays; all texts step down a level of all nodes at once.

Learning uses a bounded sample: the ``TRAIN_ROWS`` labelled documents with the smallest
hash of their id, judged by the label ``quality``.

A null text has no words and fails.  Words are runs of other bytes than 09-0D and 20.
Without labels of both kinds the trees are empty and whatever passes the base rules is
kept, unless all labels are 0.  Labels other than 0 and 1 are not used; of several labels
of a document the highest counts.  Rows that repeat are judged each for itself; an empty
table gives an empty result; extra columns are ignored.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .shared import stored, widened
from .text import SPACE, buffers, numbered, one_text, utf8_lengths, whole_rows, word_bounds

#: Bound of the sample of labelled rows that the trees are fitted to.
TRAIN_ROWS = 20_000
TREES = 40
DEPTH = 3
RATE = 0.2
BINS = 32
KEEP = 0.5
LEAST_WORDS = 50
REPEAT_PERCENT = 50

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_lines", "n_distinct_words", "n_digits", "n_upper"]
#: Features, and in which direction each may move the score (0: either).
FEATURES = {
    "words": 1,
    "word_length": 0,
    "symbol_share": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "distinct_share": 0,
    "digit_share": -1,
    "upper_share": 0,
    "words_per_line": 0,
}


def _per_text(flags, offsets):
    return np.diff(np.r_[0, np.cumsum(flags)][offsets])


def _lines(data, offsets):
    """(text, start, end) of the lines that hold a word, split at line feeds."""
    feeds = np.flatnonzero(data == 10)
    starts = np.sort(np.r_[offsets[:-1], feeds + 1])
    ends = np.sort(np.r_[feeds, offsets[1:]])
    per_text = 1 + np.diff(np.searchsorted(feeds, offsets))
    text = np.repeat(np.arange(len(offsets) - 1), per_text)
    solid = np.r_[0, np.cumsum(~SPACE[data])]
    held = solid[ends] > solid[starts]
    return text[held], starts[held], ends[held]


def _repeated_words(codes, text, kinds, texts):
    """Per text the words in three-word windows that it holds twice or more."""
    n = len(codes)
    if n < 3:
        return np.zeros(texts, np.int64)
    codes = codes.astype(np.int64)
    same = text[2:] == text[:-2]
    at = np.flatnonzero(same)
    first = codes[at] * kinds + codes[at + 1]
    if kinds > 1 << 21:  # else three numbers fit into 63 bits
        first = np.unique(first, return_inverse=True)[1]
    windows, number = np.unique(first * kinds + codes[at + 2], return_inverse=True)
    key = text[at] * max(len(windows), 1) + number
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    twin = np.zeros(len(at), bool)
    equal = ranked[1:] == ranked[:-1]
    twin[1:] |= equal
    twin[:-1] |= equal
    hit = at[order[twin]]
    marked = np.zeros(n, bool)
    for step in range(3):
        marked[hit + step] = True
    return np.bincount(text[marked], minlength=texts)


def statistics(data, offsets):
    """The columns COUNTS and MORE of every text."""
    texts = len(offsets) - 1
    starts, ends, edges = word_bounds(data, offsets)
    codes, distinct = numbered(data, starts, ends)
    words = np.diff(edges)
    text = np.repeat(np.arange(texts), words)
    kinds = max(len(distinct), 1)
    line_text, line_start, line_end = _lines(data, offsets)
    line_code, lines = numbered(data, line_start, line_end)
    pairs = np.unique(line_text * max(len(lines), 1) + line_code)
    n_lines = np.bincount(line_text, minlength=texts)
    return {
        "n_words": words,
        "word_chars": _per_text(utf8_lengths(data) & ~SPACE[data], offsets),
        "n_symbols": _per_text(_SYMBOL[data], offsets),
        "n_dup_lines": n_lines - np.bincount(pairs // max(len(lines), 1), minlength=texts),
        "n_repeat_words": _repeated_words(codes, text, kinds, texts),
        "n_lines": n_lines,
        "n_distinct_words": np.bincount(np.unique(text * kinds + codes) // kinds, minlength=texts),
        "n_digits": _per_text(_DIGIT[data], offsets),
        "n_upper": _per_text(_UPPER[data], offsets),
    }


def features(s):
    """The matrix of FEATURES from statistics."""
    words = np.maximum(s["n_words"], 1)
    chars = np.maximum(s["word_chars"], 1)
    lines = np.maximum(s["n_lines"], 1)
    return np.stack(
        [
            np.log1p(s["n_words"]), s["word_chars"] / words, s["n_symbols"] / chars,
            s["n_dup_lines"] / lines, s["n_repeat_words"] / words,
            s["n_distinct_words"] / words, s["n_digits"] / chars, s["n_upper"] / chars,
            words / lines,
        ],
        axis=1,
    )


@dataclass
class Trees:
    """Complete trees of one depth as node arrays; a leaf has no further use of its row.

    Node ``k`` of a tree asks whether ``x[feature] > threshold`` and goes on to ``2k + 1``
    or ``2k + 2``; the last level's answers are the places in ``leaves``.
    """

    bias: float
    feature: np.ndarray  # trees x nodes
    threshold: np.ndarray
    leaves: np.ndarray  # trees x 2**depth

    def score(self, x):
        total = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        nodes = self.feature.shape[1]
        for feature, threshold, leaves in zip(self.feature, self.threshold, self.leaves):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < nodes:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaves[node - nodes] if nodes else leaves[0]
        return 1 / (1 + np.exp(-np.clip(total, -700, 700)))


def boost(x, y, directions, trees=TREES, depth=DEPTH):
    """Fit trees to labels 0 and 1; ``directions`` are -1, 0 or 1 for each feature."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    bias = float(np.log(share / (1 - share)))
    nodes, ends = 2**depth - 1, 2**depth
    grid = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = [np.unique(np.quantile(c, grid)) if len(c) else c for c in x.T]
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], 1)
    all_f, all_t, all_v = [], [], []
    margin = np.full(len(y), bias)
    for _ in range(trees if 0 < y.sum() < len(y) else 0):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, np.maximum(p * (1 - p), 1e-9)
        feature, threshold = np.zeros(nodes, np.int64), np.full(nodes, np.inf)
        value, bounds = np.zeros(nodes + ends), {0: (-np.inf, np.inf)}
        where = np.zeros(len(y), np.int64)
        for node in range(nodes + ends):
            low, high = bounds[node]
            mine = np.flatnonzero(where == node)
            g, h = grad[mine].sum(), hess[mine].sum()
            # a branch that nothing of the sample reaches answers as its parent does
            value[node] = np.clip(g / (h + 1.0) if len(mine) else value[(node - 1) // 2], low, high)
            if node >= nodes:
                continue
            best = (1e-6, 0, None, value[node], value[node])
            for j in range(x.shape[1]):
                if not len(edges[j]) or len(mine) < 20:
                    continue
                b = binned[mine, j]
                gl = np.cumsum(np.bincount(b, grad[mine], len(edges[j]) + 1))[:-1]
                hl = np.cumsum(np.bincount(b, hess[mine], len(edges[j]) + 1))[:-1]
                nl = np.cumsum(np.bincount(b, minlength=len(edges[j]) + 1))[:-1]
                left = np.clip(gl / (hl + 1.0), low, high)
                right = np.clip((g - gl) / (h - hl + 1.0), low, high)
                gain = gl * left - (hl + 1) * left**2 / 2 + (g - gl) * right
                gain -= (h - hl + 1) * right**2 / 2 + g * value[node] - (h + 1) * value[node] ** 2 / 2
                gain[(nl < 10) | (len(mine) - nl < 10) | (directions[j] * (right - left) < 0)] = -1
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], j, edges[j][k], left[k], right[k])
            _, j, cut, left, right = best
            feature[node] = j
            middle = (left + right) / 2
            bounds[2 * node + 1] = bounds[2 * node + 2] = (low, high)
            if cut is None:
                where[mine] = 2 * node + 1
                continue
            threshold[node] = cut
            if directions[j] > 0:
                bounds[2 * node + 1], bounds[2 * node + 2] = (low, middle), (middle, high)
            elif directions[j] < 0:
                bounds[2 * node + 1], bounds[2 * node + 2] = (middle, high), (low, middle)
            where[mine] = 2 * node + 1 + (x[mine, j] > cut)
        leaves = RATE * value[nodes:]
        margin += leaves[where - nodes]
        all_f.append(feature)
        all_t.append(threshold)
        all_v.append(leaves)
    shape = (len(all_f), nodes)
    return Trees(
        bias, np.array(all_f, np.int64).reshape(shape), np.array(all_t).reshape(shape),
        np.array(all_v).reshape(len(all_f), ends),
    )


def with_statistics(docs):
    """``docs`` with the columns COUNTS and MORE of each whole text."""
    docs, schema = widened(docs, **dict.fromkeys(COUNTS + MORE, "long"))
    place = docs.columns.index("text")

    def run(batches):
        for batch in whole_rows(batches, place):
            found = statistics(*buffers(batch.column(place)))
            more = [pa.array(found[c].astype(np.int64)) for c in COUNTS + MORE]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *more], names=[*batch.schema.names, *COUNTS, *MORE]
            )

    return docs.mapInArrow(run, schema)


def fit(docs, labels):
    """Trees fitted to the bounded sample of labelled rows."""
    sample = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(TRAIN_ROWS)
    )
    # at most TRAIN_ROWS rows of an id and a label: a bound for the broadcast, and of one
    # text an id for the driver
    held = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    rows = stored(one_text(held, "quality"), "quality-sample")
    found = with_statistics(rows).select(*COUNTS, *MORE, "quality").toPandas()
    found = found.sort_values(list(found.columns)).reset_index(drop=True)
    x = features({c: found[c].to_numpy() for c in COUNTS + MORE})
    return boost(x, found["quality"].to_numpy().astype(np.float64), list(FEATURES.values()))


def judge(docs, trees):
    """``docs`` with COUNTS, ``base_failed``, ``quality_score`` and ``kept``."""
    kinds = dict.fromkeys(COUNTS, "long")
    kinds |= {"base_failed": "boolean", "quality_score": "double", "kept": "boolean"}
    docs, schema = widened(docs, **kinds)
    place = docs.columns.index("text")

    def run(batches):
        for batch in whole_rows(batches, place):
            s = statistics(*buffers(batch.column(place)))
            score = trees.score(features(s))
            failed = (s["n_words"] < LEAST_WORDS) | (
                100 * s["n_repeat_words"] > REPEAT_PERCENT * s["n_words"]
            )
            more = [pa.array(s[c].astype(np.int64)) for c in COUNTS]
            more += [pa.array(failed), pa.array(score), pa.array(~failed & (score >= KEEP))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *more], names=[*batch.schema.names, *kinds]
            )

    return docs.mapInArrow(run, schema)


def op6_quality(spark, sf_dir):
    """The contract's rows: every document's statistics and verdict."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    trees = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judge(docs, trees).select("doc_id", *COUNTS, "base_failed", "kept")
