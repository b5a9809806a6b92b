"""Exact top-k search by inner product, with elimination through a pivot table.

Distances of every vector to a few pivots are computed once.  For a query q and a vector
x the largest ``|d(q, p) - d(x, p)|`` over all pivots p is a lower bound of their
distance, so ``(|q|^2 + |x|^2 - bound^2) / 2`` is an upper bound of their inner product.
Candidates are evaluated in the order of that bound until it falls below the k-th score
found: what is left cannot enter the result.  The result is exact whatever the pivots.

Vectors are laid out in blocks (their numbers, pivot distances and ids), a row each.  A
block of queries meets the blocks of candidates one after another, in ``STRIPES``
separate runs whose best are merged; its k-th scores are kept from block to block, so
that later blocks are mostly eliminated.

Pivots are chosen from a bounded sample (``SAMPLE`` vectors of the smallest hash), far
from one another; the table covers every vector.

Components are ``floor(64 * x)``.  Vectors that are null or hold a null or non-finite
component take no part.  Vectors of different lengths compare as if the shorter ended in
zeros; an empty vector scores 0.  Rows are told apart by their place, not their id: with
repeated ids, each row is a candidate and, if its id is divisible by 20, a query of its
own.  A null id is a candidate and loses ties.  Scores are 64-bit numbers and exact within
them.  An empty table, or one without queries, gives an empty result.  Extra columns are
ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from .shared import stored

SCALE = 64
K = 20
QUERY_STEP = 20
PIVOTS = 16
SAMPLE = 2048
BLOCK = 4096
QUERY_BLOCK = 1024
STRIPES = 4

_BLOCK = "block int, uid binary, ids binary, named binary, width int, vectors binary, far binary"


def vectors(df, column="embedding", id_column="vec_id"):
    """(uid, vec_id, v) of the rows that take part; v holds whole numbers."""
    x = F.col(column)
    usable = x.isNotNull() & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf"))
    )
    return df.where(usable).select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(id_column).alias("vec_id"),
        F.transform(x, lambda c: F.floor(c.cast("double") * SCALE).cast("long")).alias("v"),
    )


def _matrix(lists, width=None):
    """A list array as rows, filled up with zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    width = max(width or 0, int(sizes.max()) if len(sizes) else 0)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def choose_pivots(rows, n=PIVOTS):
    """Far from one another: each next one is farthest from those chosen."""
    if not len(rows):
        return rows.astype(np.float64)
    x = rows.astype(np.float64)
    chosen, nearest = [0], np.full(len(x), np.inf)
    while len(chosen) < min(n, len(x)):
        nearest = np.minimum(nearest, ((x - x[chosen[-1]]) ** 2).sum(1))
        chosen.append(int(nearest.argmax()))
    return x[chosen]


def pivot_distances(x, pivots):
    """Distances of the rows of ``x`` to each pivot."""
    width = max(x.shape[1], pivots.shape[1])
    a = np.zeros((len(x), width))
    a[:, : x.shape[1]] = x
    b = np.zeros((len(pivots), width))
    b[:, : pivots.shape[1]] = pivots
    return np.sqrt(np.stack([((a - p) ** 2).sum(1) for p in b], 1)) if len(b) else a[:, :0]


def _lay_out(pivots):
    def run(key, table):
        order = np.argsort(table.column("uid").to_numpy())
        x = _matrix(table.column("v"))[order]
        ids = table.column("vec_id")
        named = np.array(ids.is_valid())[order]
        ids = np.array(ids.fill_null(0), np.int64)[order]
        values = [
            key[0].as_py(), table.column("uid").to_numpy()[order].astype("<i8").tobytes(), ids.tobytes(),
            named.tobytes(), x.shape[1], x.astype("<i8").tobytes(), pivot_distances(x, pivots).tobytes(),
        ]
        kinds = [pa.int32(), *[pa.binary()] * 3, pa.int32(), pa.binary(), pa.binary()]
        names = [c.split()[0] for c in _BLOCK.split(", ")]
        return pa.table([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

    return run


def _blocks(rows, count, size, pivots):
    blocks = max(1, -(-count // size))
    placed = rows.withColumn("b", F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int"))
    return placed.groupBy("b").applyInArrow(_lay_out(pivots), _BLOCK), blocks


class _Block:
    def __init__(self, row, prefix):
        get = lambda name, kind: np.frombuffer(row[prefix + name], kind)
        self.uid, self.ids, self.named = get("uid", "<i8"), get("ids", np.int64), get("named", bool)
        n = len(self.uid)
        self.x = get("vectors", "<i8").reshape(n, row[prefix + "width"])
        self.far = get("far", np.float64).reshape(n, -1)
        self.square = (self.x.astype(np.float64) ** 2).sum(1)


def _fitting(a, b):
    """Both matrices as wide as the wider, in the smallest type that is exact."""
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * width
    kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64
    return a.astype(kind), b.astype(kind)


class _Best:
    """The best K of each query of a block, so far."""

    def __init__(self, queries):
        self.queries = queries
        self.rows = [[] for _ in queries.uid]  # (-score, unnamed, id, uid), best first
        self.least = np.full(len(queries.uid), -np.inf)

    def meet(self, block):
        q, x = _fitting(self.queries.x, block.x)
        bound = np.zeros((len(q), len(x)), np.float32)
        for p in range(self.queries.far.shape[1]):
            far = self.queries.far[:, p, None].astype(np.float32) - block.far[:, p].astype(np.float32)
            np.maximum(bound, np.abs(far, out=far), out=bound)
        reach = self.queries.square[:, None] + block.square
        # more than what rounding can take off
        bound = ((reach - bound.astype(np.float64) ** 2) / 2 + 1 + 1e-5 * reach).astype(np.float32)
        bound = np.nextafter(bound, np.float32(np.inf))
        for i in np.flatnonzero(bound.max(axis=1, initial=-np.inf) >= self.least):
            self._search(i, q[i], x, bound[i], block)

    def _search(self, i, q, x, bound, block):
        left = np.flatnonzero((bound >= self.least[i]) & (block.uid != self.queries.uid[i]))
        if len(left) > 4 * K:
            top = np.argpartition(-bound[left], 2 * K)[: 2 * K]
            self._evaluate(i, q, x, left[top], block)
            left = np.delete(left, top)
            left = left[bound[left] >= self.least[i]]
        left = left[np.argsort(-bound[left], kind="stable")]
        at, step = 0, 256
        while at < len(left) and bound[left[at]] >= self.least[i]:
            self._evaluate(i, q, x, left[at : at + step], block)
            at, step = at + step, 2 * step

    def _evaluate(self, i, q, x, which, block):
        scores = x[which] @ q
        good = np.flatnonzero(scores >= self.least[i])
        if len(good) > 4 * K:  # all that tie with the K-th stay
            good = good[scores[good] >= np.partition(scores[good], -K)[-K]]
        which = which[good]
        found = zip(
            (-scores[good].astype(np.int64)).tolist(), (~block.named[which]).tolist(),
            block.ids[which].tolist(), block.uid[which].tolist(),
        )
        best = self.rows[i] = sorted([*self.rows[i], *found])[:K]
        if len(best) == K:
            self.least[i] = -best[-1][0]

    def batch(self):
        rows = [
            (int(self.queries.uid[i]), int(self.queries.ids[i]), u, None if nameless else v, -s)
            for i, best in enumerate(self.rows)
            for s, nameless, v, u in best
        ]
        columns = list(zip(*rows)) if rows else [()] * 5
        names = ["query", "query_id", "uid", "vec_id", "score"]
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=names)


def _meet(batches):
    key, best = None, None
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            if (row["q_block"], row["stripe"]) != key:
                if best:
                    yield best.batch()
                key, best = (row["q_block"], row["stripe"]), _Best(_Block(row, "q_"))
            best.meet(_Block(row, ""))
    if best:
        yield best.batch()


def top_k(rows, is_query):
    """(query_id, rank, vec_id, score) from a table made by :func:`vectors`."""
    rows = stored(rows, "vectors")
    queries = rows.where(is_query)
    sample = rows.orderBy(F.xxhash64("uid"), "uid").limit(SAMPLE).select("v").toArrow()
    pivots = choose_pivots(_matrix(sample.column("v")) if sample.num_rows else np.zeros((0, 0)))
    blocks, _ = _blocks(rows, rows.count(), BLOCK, pivots)
    q_blocks, many = _blocks(queries, queries.count(), QUERY_BLOCK, pivots)
    q_blocks = q_blocks.toDF(*[f"q_{c}" for c in q_blocks.columns])
    stripe = F.pmod(F.xxhash64("block"), F.lit(STRIPES)).cast("int")
    # each block of candidates goes to every block of queries: the work itself
    pairs = (
        blocks.withColumn("stripe", stripe)
        .withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(many - 1))))
        .join(q_blocks, "q_block")
        .repartition(many * STRIPES, "q_block", "stripe")
        .sortWithinPartitions("q_block", "stripe", "block")
    )
    found = pairs.mapInArrow(_meet, "query long, query_id long, uid long, vec_id long, score long")
    order = Window.partitionBy("query").orderBy(
        F.desc("score"), F.asc_nulls_last("vec_id"), "uid"
    )
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= K)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op7_pivots(spark, sf_dir):
    """The contract's rows: the 20 best of every query against all rows."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors(table), F.col("vec_id") % QUERY_STEP == 0)
