"""Near copies by the exact Jaccard similarity of their sets of word shingles.

A text's set holds its shingles of ``SHINGLE`` words, A-Z lowered; a shorter text is one
shingle.  Two texts are linked when their sets' Jaccard similarity is ``LEAST`` or more.
Texts of equal sets are one from the start, however many there are.

SimHash comes first: sets whose 64-bit fingerprints differ in two bits at most, found by
``simhash.links``, are candidates.  Two bits are few for texts of 0.8, so candidates also
share a band: ``ROWS`` minimum hashes of the set, out of ``BANDS`` times as many.  A pair of
similarity 0.8 shares no band with probability (1 - 0.8^4)^20, which is 2.6e-5, and more
similar ones with less.  Every candidate is verified by its whole sets.

Members of a band's group of more than ``CROWD`` are grouped anew by their rarest shingles:
similar sets share one among the 1 - 0.8 of each that the fewest of these members have.  What
comes before a shared shingle in that order is not shared, which bounds how much two sets can
have in common; pairs that cannot be similar by it, or by their sizes, are not met.  No
similar pair is lost by it.

A group is not compared pairwise: in a round each member that is not yet connected to
them meets a few of the group, which then leave it, first those with the fewest rare
shingles.  Their number grows from round to round, and a group is done when all its members
are connected.  So groups of near copies take about one comparison a member, and yet no
pair of a group that the components need is left out.

Texts without a word, null or empty ones among them, have the empty set and are linked to
one another.  Rows are told apart by all their columns, whatever these are called; equal
rows are one.  Ids may repeat or be null, and decide only which row is kept.  An empty
table gives an empty result.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from . import bittable, simhash
from .bittable import BitTable
from .shared import fresh, stored
from .simhash import components
from .text import LOWER, buffers, forget, numbered, release, whole_rows, word_bounds

SHINGLE = 5
LEAST = 0.8
BANDS, ROWS = 20, 4
#: Members of a larger group meet by their rarest shingles instead.
CROWD = 16
#: Bytes of text handled at once.
PART_BYTES = 2 << 20

_RNG = np.random.default_rng(11)
_TIMES = _RNG.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _RNG.integers(0, 1 << 63, BANDS * ROWS, np.uint64)


def _mixed(x):
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(data, offsets):
    """(hashes, edges): the sorted distinct shingle hashes of each text."""
    data = LOWER[data]
    starts, ends, edges = word_bounds(data, offsets)
    codes, words = numbered(data, starts, ends)
    h = np.array([xxhash.xxh64_intdigest(w, 17) for w in words.to_pylist()], np.uint64)
    h = h[codes] if len(h) else np.zeros(0, np.uint64)
    n = np.diff(edges)
    shingles = np.where(n == 0, 0, np.maximum(n - SHINGLE + 1, 1))
    text = np.repeat(np.arange(len(n)), shingles)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    first = np.repeat(edges[:-1], shingles) + nth
    size = np.minimum(n, SHINGLE)[text]
    found = np.zeros(len(text), np.uint64)
    for k in range(SHINGLE):
        more = _mixed(found + h[np.minimum(first + k, max(len(h) - 1, 0))] + np.uint64(k + 1)) if len(h) else found
        found = np.where(size > k, more, found)
    order = np.lexsort((found, text))
    text, found = text[order], found[order]
    new = np.r_[True, (text[1:] != text[:-1]) | (found[1:] != found[:-1])] if len(text) else np.zeros(0, bool)
    text, found = text[new], found[new]
    return found, np.searchsorted(text, np.arange(len(n) + 1))


def keys(hashes, edges):
    """A signed 64-bit digest of each set."""
    raw = hashes.astype("<u8").tobytes()
    found = [xxhash.xxh3_64_intdigest(raw[8 * a : 8 * b]) for a, b in zip(edges, edges[1:])]
    return np.array(found, np.uint64).view(np.int64)


def bands(hashes, edges):
    """BANDS signed numbers per set: equal with a chance of its similarity to the ROWS."""
    n = len(edges) - 1
    out = np.zeros((n, BANDS), np.uint64)
    full = np.flatnonzero(np.diff(edges))
    if len(full):
        for j in range(BANDS * ROWS):
            least = np.minimum.reduceat(_mixed_light(hashes, j), edges[full])
            band = j // ROWS
            out[full, band] = _mixed(out[full, band] + least + np.uint64(j + 1))
    return out.view(np.int64)


def _mixed_light(hashes, j):
    x = (hashes + _PLUS[j]) * _TIMES[j]
    return x ^ (x >> np.uint64(32))


def _signed(batches):
    """(id, row, key, size, fp, bands) of (id, row's hashes, text)."""
    forget()
    for batch in whole_rows(batches, 3, PART_BYTES):
        hashes, edges = shingle_sets(*buffers(batch.column(3)))
        found = bands(hashes, edges)
        lists = pa.ListArray.from_arrays(
            np.arange(0, found.size + 1, BANDS, dtype=np.int32), pa.array(found.ravel())
        )
        more = [keys(hashes, edges), np.diff(edges), simhash.majorities(hashes, edges)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], *map(pa.array, more), lists],
            names=["id", "h1", "h2", "key", "size", "fp", "bands"],
        )


def _sets(wanted):
    """(key, set) of the texts whose key is in the table, once in a task."""

    def run(batches):
        table, met = BitTable(wanted), set()
        for batch in whole_rows(batches, 0, PART_BYTES):
            hashes, edges = shingle_sets(*buffers(batch.column(0)))
            key = keys(hashes, edges)
            raw, held = hashes.astype("<u8").tobytes(), []
            for i in np.flatnonzero(table.has(key.view(np.uint64))):
                if key[i] not in met:
                    met.add(key[i])
                    held.append(i)
            yield pa.record_batch(
                [
                    pa.array(key[held]),
                    pa.array([raw[8 * edges[i] : 8 * edges[i + 1]] for i in held], pa.binary()),
                ],
                names=["key", "held"],
            )

    return run


def _spread(batches):
    """(key, size, value): a row for every shingle of a set."""
    for batch in batches:
        data, at = buffers(batch.column(1))
        sizes, step = np.diff(at) // 8, 1 << 20
        key, size = (np.repeat(x, sizes) for x in (batch.column(0).to_numpy(), sizes))
        value = data.view("<i8")
        for i in range(0, len(value), step):
            yield pa.record_batch(
                [pa.array(x[i : i + step]) for x in (key, size, value)], names=["key", "size", "value"]
            )
        release()


def _similar(x, y):
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= LEAST * (len(x) + len(y) - both)


def _verified(batches):
    """The pairs (a, b) whose sets are similar; sets are taken from a batch one by one."""
    for batch in batches:
        sides = [buffers(batch.column(i)) for i in (2, 3)]
        keep = []
        for i in range(batch.num_rows):
            x, y = (data[at[i] : at[i + 1]].view("<u8") for data, at in sides)
            keep.append(_similar(x, y))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
        release()


def _has_map(kind):
    if isinstance(kind, StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, MapType) or isinstance(kind, ArrayType) and _has_map(kind.elementType)


def row_hashes(docs):
    """Two 64-bit hashes over all columns of a row: equal rows have equal ones."""
    columns = []
    for f in docs.schema.fields:
        name = F.col("`" + f.name.replace("`", "``") + "`")
        # maps cannot be hashed: their text is
        value = F.to_json(F.struct(name)) if _has_map(f.dataType) else name
        columns += [value, F.isnull(name)]
    return F.xxhash64(F.lit(1), *columns), F.xxhash64(F.lit(2), *columns)


def close(one):
    """Pairs (a, b) of keys, a < b, that SimHash finds; ``one`` has a row (key, fp) a set.

    Sets of one fingerprint are paired with its smallest key, which stands for it in others.
    """
    least = stored(one.groupBy("fp").agg(F.min("key").alias("least")), "similar-fps")
    pairs = simhash.links(least.select("fp"))
    for side in "ab":
        pairs = pairs.join(least.select(F.col("fp").alias(side), F.col("least").alias(f"key_{side}")), side)
    same = one.join(least, "fp").where("key != least").select(F.col("least").alias("key_a"), F.col("key").alias("key_b"))
    return pairs.select("key_a", "key_b").unionAll(same).select(
        F.least("key_a", "key_b").alias("a"), F.greatest("key_a", "key_b").alias("b")
    )


def _needed(x, y):
    """Shingles that sets of these sizes share if they are similar, a little less for rounding."""
    return (x + y) * (LEAST / (1 + LEAST)) - 1e-6


def crowded(sets):
    """(value, key, size, room) of (key, held): groups of sets that share a rare shingle.

    Every similar pair is in a group where each side's ``room``, its number of shingles from
    that one on in the order of rareness, is not below what the pair shares.
    """
    shingles = sets.mapInArrow(_spread, "key long, size long, value long")
    # shingles of one set alone are the rarest, and only their number matters
    counts = shingles.groupBy("value").agg(F.count("*").alias("n")).where("n > 1")
    rare = F.array_sort(F.collect_list(F.struct("n", "value")))
    ranked = shingles.join(counts, "value").groupBy("key", "size").agg(rare.alias("rare"))
    alone = F.col("size") - F.size("rare")
    places = F.col("size") - F.ceil(F.col("size") * LEAST - 1e-6) + 1
    first = F.slice("rare", 1, F.greatest(places - alone, F.lit(0)).cast("int"))
    met = ranked.select("key", "size", alone.alias("alone"), F.posexplode(first).alias("place", "shingle"))
    met = met.select(
        F.col("shingle.value").alias("value"), "key", "size", (F.col("size") - F.col("alone") - F.col("place")).alias("room")
    )
    met = stored(met, "similar-rare")
    least = met.groupBy("value").agg(F.min("size").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n")
    return met.join(least, "value").where(F.col("room") >= _needed(F.col("size"), F.col("least"))).drop("least")


def _alike(pairs, sets):
    """The similar ones of the pairs (a, b)."""
    pairs = pairs.join(sets.select(F.col("key").alias("a"), F.col("held").alias("x")), "a")
    pairs = pairs.join(sets.select(F.col("key").alias("b"), F.col("held").alias("y")), "b")
    pairs = pairs.select("a", "b", "x", "y").mapInArrow(_verified, "a long, b long")
    return stored(pairs, "similar-links")


def linked(docs, id_column="doc_id"):
    """(id, h1, h2, key, root) of every row; rows of one root are near copies."""
    h1, h2 = row_hashes(docs)
    rows = docs.select(F.col(id_column).alias("id"), h1.alias("h1"), h2.alias("h2"), "text")
    id_type = rows.schema["id"].dataType.simpleString()
    kinds = f"id {id_type}, h1 long, h2 long, key long, size long, fp long, bands array<long>"
    rows = stored(rows.mapInArrow(_signed, kinds), "similar-rows")
    one = rows.groupBy("key").agg(*(F.first(c).alias(c) for c in ("size", "fp", "bands")))
    one = stored(one, "similar-distinct")
    placed = one.select("key", "size", F.posexplode("bands").alias("band", "value"))
    shared = placed.groupBy("band", "value").agg(F.count("*").alias("n")).where("n > 1")
    groups = stored(placed.join(shared, ["band", "value"]), "similar-groups")
    pairs = stored(close(one.select("key", "fp")), "similar-close")
    # the sets of the candidates alone, from a second look at the texts where they lie
    both = pairs.select(F.explode(F.array("a", "b")).alias("key"))
    wanted = bittable.shipped(groups.select("key").unionAll(both))
    sets = docs.select("text").mapInArrow(_sets(wanted), "key long, held binary").dropDuplicates(["key"])
    sets = stored(sets, "similar-sets")
    wanted.destroy()  # the driver lives on, and other stages follow
    few = F.col("n") <= CROWD
    crowd = groups.where(~few).select("key").distinct()
    rare = crowded(sets.join(crowd, "key", "left_semi"))
    columns = ["band", "value", "key", "size", "room"]
    groups = groups.where(few).withColumn("room", F.col("size")).select(columns).unionAll(
        rare.withColumn("band", F.lit(-1)).select(columns)
    )
    found, roots, places = None, None, 1
    new = _alike(pairs, sets)
    while True:
        if not new.isEmpty():
            found = new if found is None else found.unionAll(new)
            roots = components(found).select(F.col("fp").alias("key"), "root")
        here = groups if roots is None else groups.join(roots, "key", "left")
        root = F.col("key") if roots is None else F.coalesce("root", "key")
        here = here.withColumn("root", root)
        apart = here.groupBy("band", "value").agg(F.min("root").alias("x"), F.max("root").alias("y"))
        here = stored(
            here.join(apart.where("x < y").select("band", "value"), ["band", "value"]), "similar-apart"
        )
        if here.isEmpty():
            break
        # a member of each place of a group meets all others, then leaves
        place = F.pmod(F.xxhash64("key"), F.lit(places))
        first = here.groupBy("band", "value", place.alias("place")).agg(
            F.min(F.struct((F.col("size") - F.col("room")).alias("lost"), "key", "root", "size", "room")).alias("first")
        )
        first = stored(first.select("band", "value", "first.*"), "similar-first")
        by = first.select("band", "value", *(F.col(c).alias(f"first_{c}") for c in ("key", "root", "size", "room")))
        needed = _needed(F.col("size"), F.col("first_size"))
        met = here.join(by, ["band", "value"]).where(
            (F.col("root") != F.col("first_root")) & (F.col("room") >= needed) & (F.col("first_room") >= needed)
        )
        pairs = met.select(F.least("key", "first_key").alias("a"), F.greatest("key", "first_key").alias("b"))
        new = _alike(pairs.distinct(), sets)
        groups = here.join(first, ["band", "value", "key"], "left_anti").select(columns)
        places *= 8
    if roots is None:
        return rows.select("id", "h1", "h2", "key", F.col("key").alias("root"))
    rows = rows.select("id", "h1", "h2", "key").join(roots, "key", "left")
    return rows.select("id", "h1", "h2", "key", F.coalesce("root", "key").alias("root"))


def distinct_documents(docs, id_column="doc_id"):
    """One row of each group of near copies: that of the smallest id, a null one last.

    Of rows with the same id the smallest set, then the smallest row's hash, is kept.
    """
    order = F.struct(F.isnull("id").alias("n"), "id", "key", "h1", "h2")
    best = linked(docs, id_column).groupBy("root").agg(F.min(order).alias("best"))
    a, b = fresh(docs.columns, "h1", "h2")
    best = best.select(F.col("best.h1").alias(a), F.col("best.h2").alias(b))
    h1, h2 = row_hashes(docs)
    kept = docs.withColumns({a: h1, b: h2}).join(best, [a, b], "left_semi")
    return kept.dropDuplicates([a, b]).drop(a, b)
