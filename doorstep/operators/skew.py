"""Joins that stay balanced when a few keys hold much of one side."""

from pyspark.sql import functions as F

# Counters of the sketch per key that it looks for.
TRACKED_PER_KEY = 64
TRACKED_MOST = 1_000_000

BROADCAST_BYTES = 64 << 20


def _key_hash(columns):
    return F.xxhash64(*columns)


def _partitions(df):
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)


def hot_keys(df, columns, partitions=None):
    """{key hash: share of rows} for keys that alone would fill a shuffle partition.

    With ``partitions`` shuffle partitions these are the keys with at least that part of
    the rows, so there are no more of them than partitions.

    One pass with a fixed-size sketch per task and one row back.  A missed or extra
    key changes only the balance of a join, never its result.  Also returns the share
    of rows with a null among ``columns``.
    """
    partitions = partitions or _partitions(df)
    tracked = min(max(partitions * TRACKED_PER_KEY, 4096), TRACKED_MOST)
    names = [F.col(c) for c in columns]
    any_null = F.lit(False)
    for name in names:
        any_null = any_null | name.isNull()
    row = (
        df.select(any_null.alias("_null"), _key_hash(names).alias("_hash"))
        .agg(
            F.expr(
                f"approx_top_k(CASE WHEN NOT _null THEN _hash END,"
                f" {partitions}, {tracked})"
            ).alias("top"),
            F.count(F.lit(1)).alias("n"),
            F.count_if("_null").alias("nulls"),
        )
        .first()
    )
    total = row["n"] or 0
    hot = {
        item["item"]: item["count"] / total
        for item in (row["top"] or [])
        if item["item"] is not None and item["count"] * partitions >= total
    }
    return hot, (row["nulls"] / total if total else 0.0)


def fits_broadcast(df, limit_bytes=BROADCAST_BYTES):
    """Whether the rows of ``df`` together stay within a size, measured now."""
    text = F.octet_length(F.to_json(F.struct(*df.columns)))
    weight = F.coalesce(text, F.lit(0)) + 32 + 16 * len(df.columns)
    size = df.agg(F.sum(weight.cast("double"))).first()[0]
    return (size or 0) <= limit_bytes


def lookup_join(
    left, dimension, keys, how="left", limit_bytes=BROADCAST_BYTES, fits=None
):
    """Join with a side expected to be small: broadcast if it is, salted otherwise.

    ``fits`` is the answer of ``fits_broadcast`` where the caller has it already.
    """
    if fits is None:
        fits = fits_broadcast(dimension, limit_bytes)
    if not fits:
        return salted_join(left, dimension, keys, how)
    condition = F.lit(True)
    for a, b in keys:
        condition = condition & (F.col(a) == F.col(b))
    return left.join(F.broadcast(dimension), condition, how)


def salted_join(left, right, keys, how="left", extra=None):
    """Equi-join on ``keys`` = [(left column, right column)], splitting hot left keys.

    Rows of a hot key are spread over several salts by the input partition they come
    from, which is the same when a task is run again.  The right rows of just those
    keys are repeated once per salt.  Left rows with a null key match nothing; they
    are spread too, instead of meeting in one task.  ``how`` is inner, left,
    left_semi or left_anti: each left row is in one place, so each stays correct.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salted_join cannot do a {how} join")
    left_keys = [a for a, _ in keys]
    # The hash depends on the type, so both sides hash a key as the left side's type.
    kinds = [left.schema[a].dataType for a in left_keys]
    right_keys = [F.col(b).cast(t) for (_, b), t in zip(keys, kinds)]
    partitions = _partitions(left)
    hot, null_share = hot_keys(left, left_keys, partitions)

    condition = F.lit(True)
    for a, b in keys:
        condition = condition & (F.col(a) == F.col(b))
    if extra is not None:
        condition = condition & extra
    if not hot and null_share * partitions < 1:
        return left.join(right, condition, how)

    spread = {h: max(2, round(2 * share * partitions)) for h, share in hot.items()}

    def salts(columns):
        if not spread:
            return F.lit(1)
        table = F.create_map(*[F.lit(v) for pair in spread.items() for v in pair])
        return F.coalesce(
            F.try_element_at(table, _key_hash(columns)), F.lit(1)
        )

    any_null = F.lit(False)
    for a in left_keys:
        any_null = any_null | F.col(a).isNull()
    left = left.withColumn(
        "_salt",
        F.pmod(
            F.spark_partition_id(),
            F.when(any_null, F.lit(max(partitions, 2))).otherwise(salts(left_keys)),
        ),
    )
    right = right.withColumn(
        "_salt_r", F.explode(F.sequence(F.lit(0), salts(right_keys) - 1))
    )
    joined = left.join(right, condition & (F.col("_salt") == F.col("_salt_r")), how)
    return joined.drop("_salt", "_salt_r")
