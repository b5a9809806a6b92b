"""Checks that gate the publication of a layer."""

from pyspark.sql import functions as F


class LayerCheckFailed(Exception):
    def __init__(self, failures):
        self.failures = list(failures)
        super().__init__("; ".join(str(f) for f in self.failures))


class KeySetMismatch(LayerCheckFailed):
    """Source and target do not hold the same set of keys."""


class NotOneSource(LayerCheckFailed):
    """A table mixes address-base versions, or is empty."""


def key_set_check(source, target, key="uprn"):
    """One row comparing the key sets of two tables.

    ``match`` needs equal sets and no repeated key in the target; the source may
    repeat keys.  Both tables are combined per key before their one shuffle, and the
    sets are compared key by key, so the result does not rest on the checksums, which
    are there to be logged.  Empty tables never match.
    """

    def side(df, in_source, in_target):
        return df.select(
            F.col(key).cast("string").alias("k"),
            F.lit(in_source).alias("s"),
            F.lit(in_target).alias("t"),
        )

    per_key = (
        side(source, 1, 0)
        .unionAll(side(target, 0, 1))
        .groupBy("k")
        .agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    )
    named = F.col("k").isNotNull()
    in_source, in_target = F.col("s") > 0, F.col("t") > 0

    def checksum(present):
        # xxhash64 maps null to a constant, so only real keys are hashed.
        return F.hex(F.bit_xor(F.when(present & named, F.xxhash64("k"))))

    return per_key.agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("source_row_count"),
        F.coalesce(F.sum("t"), F.lit(0)).alias("target_row_count"),
        F.count_if(in_source & named).alias("source_distinct_count"),
        F.count_if(in_target & named).alias("target_distinct_count"),
        checksum(in_source).alias("source_uprn_checksum"),
        checksum(in_target).alias("target_uprn_checksum"),
        F.count_if(in_source != in_target).alias("_differing"),
    ).select(
        "source_row_count",
        "target_row_count",
        "source_distinct_count",
        "target_distinct_count",
        "source_uprn_checksum",
        "target_uprn_checksum",
        F.when(
            (F.col("_differing") == 0)
            & (F.col("target_distinct_count") == F.col("target_row_count"))
            & (F.col("target_distinct_count") > 0),
            "match",
        )
        .otherwise("mismatch")
        .alias("match_status"),
    )


def single_source_check(table, column="addressbase_source"):
    """One row: the number of distinct sources and whether it is exactly one."""
    return table.agg(F.count_distinct(column).alias("source_count")).select(
        "source_count", (F.col("source_count") == 1).alias("single_source")
    )


def assert_key_sets(source, target, key="uprn"):
    row = key_set_check(source, target, key).first()
    if row["match_status"] != "match":
        raise KeySetMismatch([f"key sets differ: {row.asDict()}"])
    return row


def assert_single_source(table, column="addressbase_source"):
    row = single_source_check(table, column).first()
    if not row["single_source"]:
        raise NotOneSource([f"{row['source_count']} sources in {column}, not 1"])
    return row


def check_layer(source, target, key="uprn", column="addressbase_source"):
    """Both checks; all failures are gathered before raising."""
    failures = []
    for check in (
        lambda: assert_key_sets(source, target, key),
        lambda: assert_single_source(target, column),
    ):
        try:
            check()
        except LayerCheckFailed as error:
            failures.append(error)
    if failures:
        raise LayerCheckFailed(failures)
