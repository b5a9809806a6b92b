"""Near-duplicates by SimHash, found through deletion variants of half fingerprints.

A fingerprint has 64 bits.  Cut into two halves, two fingerprints at most two bits apart
agree in one half but for at most one bit.  So each distinct fingerprint is indexed
under 64 variants: either half with one of its 32 bits taken out (the place of the bit
is part of the key).  Fingerprints that share a variant are candidates; an equality join
brings them together and their distance is verified.

Most variants are held by one fingerprint and go at once.  A variant held by more than
``CROWD`` is not compared pairwise: its members are indexed once more, under the bits
they do not share and those bits with one flipped (two members at most two bits apart
meet at a value in between), which makes small groups whose members are compared with
the group's first.  No pair is lost by it.

Components are found by passing the smallest neighbour on, in rounds of two joins
(large star, small star) that cut their lineage in the shared folder.  Only distinct
fingerprints take part, so copies cost nothing, however many there are.

Null and empty texts, and such without a word, have fingerprint zero, linked like any
other.  A null id takes part but never names a component unless all its ids are null
(the component's id is null then).  Rows that repeat get the same result each.  An empty
table gives an empty result.  Extra columns are ignored.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from .shared import stored, widened
from .text import LOWER, buffers, whole_rows, word_bounds

SHINGLE = 3
SEED = 42
#: A variant shared by more fingerprints than this is indexed a second time.
CROWD = 32
#: Bytes of text hashed at once; shingles take twenty times as much.
PART_BYTES = 2 << 20

_HALF = 0xFFFFFFFF


def shingle_hashes(data, offsets):
    """(hashes of all shingles, per text the number of them before it)."""
    starts, ends, edges = word_bounds(data, offsets)
    data = LOWER[data]
    # the words again, each behind one blank
    lengths = ends - starts
    places = np.cumsum(lengths + 1) - lengths  # of each word, behind its blank
    total = int(lengths.sum()) + len(lengths)
    packed = np.full(total, 32, np.uint8)
    solid = np.ones(total, bool)
    solid[places - 1] = False
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += np.int8(1)
    inside[ends] -= np.int8(1)
    packed[solid] = data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
    packed = packed.tobytes()
    words = np.diff(edges)
    shingles = np.where(words == 0, 0, np.maximum(words - SHINGLE + 1, 1))
    counts = np.r_[0, np.cumsum(shingles)]
    nth = np.arange(counts[-1]) - np.repeat(counts[:-1], shingles)
    first = np.repeat(edges[:-1], shingles) + nth
    last = first + np.repeat(np.minimum(words, SHINGLE), shingles) - 1
    low, high = places[first].tolist(), (places[last] + lengths[last]).tolist()
    h = xxhash.xxh64_intdigest
    found = [h(packed[a:b], SEED) for a, b in zip(low, high)]
    return np.array(found, np.uint64), counts


def fingerprints(data, offsets):
    """One 64-bit fingerprint per text, as signed numbers."""
    return majorities(*shingle_hashes(data, offsets))


def majorities(hashes, counts):
    """Per text the bits set in over half of its hashes; ``counts``: those before each text."""
    n = len(counts) - 1
    ones = np.zeros((n, 64), np.int64)
    text = np.repeat(np.arange(n), np.diff(counts))
    for at in range(0, len(hashes), 1 << 17):
        part = hashes[at : at + (1 << 17)].astype(">u8").view(np.uint8).reshape(-1, 8)
        owner = text[at : at + (1 << 17)]
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        # unsigned bytes hold the sums of 255 rows; take them in steps of 128
        cuts = np.unique(np.r_[first, np.arange(0, len(owner), 128)])
        sums = np.add.reduceat(np.unpackbits(part, axis=1), cuts, axis=0, dtype=np.uint8)
        np.add.at(ones, owner[cuts], sums)
    bits = 2 * ones > np.diff(counts)[:, None]
    return np.packbits(bits, axis=1).view(">u8").astype(np.uint64).view(np.int64).ravel()


def with_fingerprint(docs, column="fp"):
    """``docs`` with the signed fingerprint of each whole text as ``column``."""
    docs, schema = widened(docs, **{column: "long"})
    place = docs.columns.index("text")

    def run(batches):
        for batch in whole_rows(batches, place, PART_BYTES):
            fp = pa.array(fingerprints(*buffers(batch.column(place))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, fp], names=[*batch.schema.names, column]
            )

    return docs.mapInArrow(run, schema)


def _variants(distinct):
    """(half with a bit taken out, which, fp): 64 rows a fingerprint."""
    bit = F.col("bit")
    half = F.when(bit < 32, F.shiftrightunsigned("fp", 32)).otherwise(F.col("fp").bitwiseAND(_HALF))
    gap = F.lit(1).cast("long")
    rows = distinct.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("bit"))
    mask = F.expr("shiftleft(1L, bit % 32)")
    key = half.bitwiseAND(F.lit(_HALF).cast("long").bitwiseXOR(mask)) * 64 + bit * gap
    return rows.select(key.alias("key"), "fp")


def _near(a, b):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= 2


def links(distinct):
    """Pairs (a, b), a < b, of distinct fingerprints that keep all linked ones connected.

    Every pair at most two bits apart is either among them or joined by a path of them.
    """
    # one shuffle of the variants: each is counted where its holders lie together
    holders = F.count("*").over(Window.partitionBy("key"))
    held = stored(_variants(distinct).withColumn("n", holders).where("n > 1"), "simhash-held")
    few = held.where(F.col("n") <= CROWD)
    pairs = (
        few.select("key", F.col("fp").alias("a"))
        .join(few.select("key", F.col("fp").alias("b")), "key")
        .where((F.col("a") < F.col("b")) & _near("a", "b"))
        .select("a", "b")
    )
    # in a crowd: the half that is not indexed, and it with one bit flipped
    bit = F.expr("(shiftright(key, 5) & 1) * 32 + flip")  # upper half is indexed by bits 0-31
    around = (
        held.where(F.col("n") > CROWD)
        .withColumn("flip", F.explode(F.sequence(F.lit(-1), F.lit(32))))
        .withColumn("whole", F.expr("IF((key & 63) < 32, fp & 4294967295, shiftrightunsigned(fp, 32))"))
        .withColumn("taken", F.expr("IF((key & 63) < 32, shiftrightunsigned(fp, 32), fp & 4294967295)"))
        .withColumn("out", F.expr("shiftrightunsigned(taken, CAST(key & 31 AS INT)) & 1"))
        # flips: none, one of the 32 bits of the other half, or the bit that was taken out
        .withColumn("value", F.expr("IF(flip BETWEEN 0 AND 31, whole ^ shiftleft(1L, flip), whole)"))
        .withColumn("side", F.expr("IF(flip = 32, 1 - out, out)"))
        .select("key", "value", "side", "fp")
    )
    meet = around.groupBy("key", "value", "side").agg(
        F.min("fp").alias("a"), F.collect_set("fp").alias("fps")
    )
    star = (
        meet.where(F.size("fps") > 1)
        .select("a", F.explode("fps").alias("b"))
        .where((F.col("a") < F.col("b")) & _near("a", "b"))
    )
    return pairs.unionAll(star).distinct()


def components(pairs):
    """(fp, root): the smallest fingerprint reachable, for every one in ``pairs``."""
    edges = stored(pairs, "simhash-links")
    size = -1
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # large star: every larger neighbour to the smallest of all
        large = (
            both.where("b > a").join(low, "a").select(F.col("m").alias("a"), "b").where("a < b").distinct()
        )
        # small star: every smaller neighbour, and itself, to the smallest of them
        small_low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(small_low, "b")
        nxt = (
            small.select(F.col("m").alias("a"), "b")
            .unionAll(small.where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b")))
            .where("a < b")
            .distinct()
        )
        edges = stored(nxt, "simhash-links")
        now = edges.agg(
            F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))
        ).first()
        if tuple(now) == size:
            break
        size = tuple(now)
    return edges.select(F.col("b").alias("fp"), F.col("a").alias("root"))


def near_duplicates(docs, id_column="doc_id"):
    """(id, fp, component_id) of every row: linked at two or fewer differing bits."""
    rows = stored(with_fingerprint(docs.select(id_column, "text")).select(id_column, "fp"), "simhash-fps")
    distinct = stored(rows.groupBy("fp").agg(F.min(id_column).alias("least")), "simhash-distinct")
    found = components(links(distinct.select("fp")))
    rooted = distinct.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = rooted.join(named, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select(id_column, "fp", "component_id")


def op5_simhash(spark, sf_dir):
    """The contract's rows: every document's fingerprint and component."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
