"""Sums over rows or keys that can be merged: what changed, and are two tables the same.

A sum holds the number of rows and two sums of 61-bit hashes by a prime.  Sums of parts add
up to the sum of the whole, and rows that went can be taken away again, so a stored sum
follows a table by its changes alone.  Two sets of rows with equal sums are equal but for
chance (about 2**-122); repeated rows count as often as they stand there.
"""

from pyspark.sql import functions as F

from .skew import lookup_join

PRIME = (1 << 61) - 1
SUMS = ["n", "s1", "s2"]


def _hash(columns, seed):
    # a null leaves a hash as it is, so where the nulls are is hashed too
    parts = [x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return F.pmod(F.xxhash64(F.lit(seed), *parts), F.lit(PRIME)).cast("decimal(20, 0)")


def _total(column):
    return (F.sum(column) % PRIME).cast("long")


def content_sums(rows, by=(), columns=None):
    """(by..., n, s1, s2) of the rows' ``columns``, all of them by default."""
    columns = columns or rows.columns
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(_total(_hash(columns, 1)), F.lit(0)).alias("s1"),
        F.coalesce(_total(_hash(columns, 2)), F.lit(0)).alias("s2"),
    )


def merged(*signed, by=()):
    """The sums of tables that are added (1) or taken away (-1): ``(sums, sign)`` each."""
    every = None
    for sums, sign in signed:
        part = sums.select(*by, *[(F.col(c) * sign).alias(c) for c in SUMS])
        every = part if every is None else every.unionByName(part)
    wide = [F.sum(F.col(c).cast("decimal(20, 0)")) for c in ("s1", "s2")]
    return every.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        *[F.coalesce(F.pmod(w, F.lit(PRIME)), F.lit(0)).cast("long").alias(c) for w, c in zip(wide, ("s1", "s2"))],
    )


def key_change(before, deleted, inserted, key="uprn"):
    """(keys that came, keys that went) of the distinct keys of a table, by its changes.

    ``before`` is looked through for the changed keys only, without being shuffled where
    those are few.  A null key is no key.
    """
    def counted(df, sign):
        return df.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("_k"), F.lit(sign).alias("_d"))

    change = counted(deleted, -1).unionAll(counted(inserted, 1)).groupBy("_k").agg(F.sum("_d").alias("_change"))
    held = before.select(F.col(key).cast("string").alias("_held"))
    held = lookup_join(held, change.select("_k"), [("_held", "_k")], "left_semi")
    held = held.groupBy("_held").agg(F.count(F.lit(1)).alias("_had"))
    both = change.join(held, F.col("_k") == F.col("_held"), "left").withColumn(
        "_had", F.coalesce("_had", F.lit(0))
    )
    has = F.col("_had") + F.col("_change") > 0
    came = both.where((F.col("_had") == 0) & has).select(F.col("_k").alias(key))
    went = both.where((F.col("_had") > 0) & ~has).select(F.col("_k").alias(key))
    return came, went


def distinct_key_sums(df, key="uprn"):
    """The sums of a table's distinct keys."""
    keys = df.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias(key))
    return content_sums(keys.distinct())


def key_sums(df, key="uprn"):
    """The sums of a table's keys as they stand; a null key counts as a row."""
    return content_sums(df.select(F.col(key).cast("string").alias(key)))


def sums_check(source, target):
    """One row: do a target's keys equal the distinct ones of its source, each once?

    ``source`` holds ``distinct_key_sums``, ``target`` holds ``key_sums``.  Equal sums mean
    that the target's rows are the source's distinct keys, so none repeats.
    """
    theirs = target.select(*[F.col(c).alias(f"_{c}") for c in SUMS])
    same = F.lit(True)
    for c in SUMS:
        same = same & (F.col(c) == F.col(f"_{c}"))
    return source.join(F.broadcast(theirs)).select(
        F.col("n").alias("source_distinct_count"), F.col("_n").alias("target_row_count"),
        F.when(same & (F.col("n") > 0), "match").otherwise("mismatch").alias("match_status"),
    )
