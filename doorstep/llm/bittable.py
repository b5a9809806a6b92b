"""A set of 64-bit keys as a bit table of one size, known to all tasks.

What is broadcast has ``TABLE_BITS`` bits however many keys there are.  No key that was put
in is missed; others may seem to be in, the more the fuller the table is, so what passes is
to be checked by its user.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

#: Bits of a table: 16 MB.
TABLE_BITS = 27


def mixed(x):
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _places(keys):
    """Places in a table: the keys mixed, since they may have few bits."""
    return (mixed(keys) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


class BitTable:
    """``has`` for a broadcast table."""

    def __init__(self, shipped):
        self.bits = np.frombuffer(shipped.value, np.uint8)

    def has(self, keys):
        at = _places(keys)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _positions(batches):
    for batch in batches:
        keys = batch.column(0).to_numpy().view(np.uint64)
        yield pa.record_batch([pa.array(np.unique(_places(keys)))], names=["at"])


def shipped(keys):
    """Broadcast the table of a DataFrame's only column, signed 64-bit keys."""
    spark = keys.sparkSession
    # these functions number positions from 1
    place = F.col("at") + 1
    buckets = keys.mapInArrow(_positions, "at long").groupBy(F.bitmap_bucket_number(place).alias("bucket"))
    buckets = buckets.agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    raw = bytearray((1 << TABLE_BITS) // 8)
    for row in buckets.toLocalIterator():
        at = (row.bucket - 1) * len(row.bits)
        raw[at : at + len(row.bits)] = row.bits
    return spark.sparkContext.broadcast(bytes(raw))
