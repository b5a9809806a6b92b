import pytest
from pyspark.sql import functions as F

from doorstep.operators.skew import fits_broadcast, hot_keys, lookup_join, salted_join

from conftest import rows_of


@pytest.fixture(scope="module")
def sides(spark):
    """A third of the left rows share a key, a third have none."""
    left = (
        spark.range(0, 3000, 1, 6)
        .withColumn("k", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")))
        .withColumn("k2", F.when(F.col("id") % 3 == 0, F.lit("a")).otherwise(F.lit("b")))
    )
    right = spark.createDataFrame(
        [(7, "a", "x"), (7, "a", "y"), (4, "b", "z"), (None, "a", "w"), (7, "b", "v")],
        "rk int, rk2 string, v string",
    )
    return left, right


def test_hot_keys(sides):
    left, _ = sides
    hot, nulls = hot_keys(left, ["k"])
    assert len(hot) == 1 and abs(list(hot.values())[0] - 1 / 3) < 0.01
    assert abs(nulls - 1 / 3) < 0.01


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("extra", [None, "v <> 'y'"])
def test_equals_plain_join(sides, how, extra):
    left, right = sides
    condition = (F.col("k") == F.col("rk")) & (F.col("k2") == F.col("rk2"))
    more = None if extra is None else F.expr(extra)
    if more is not None:
        condition = condition & more
    plain = left.join(right, condition, how)
    salted = salted_join(left, right, [("k", "rk"), ("k2", "rk2")], how, more)
    assert salted.columns == plain.columns
    assert rows_of(salted) == rows_of(plain)


def test_unhandled_kinds_are_refused(sides):
    with pytest.raises(ValueError):
        salted_join(*sides, [("k", "rk")], how="full")


def test_hot_rows_are_spread(spark, sides):
    left, right = sides
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = salted_join(left, right, [("k", "rk")], "left")
        by_task = (
            joined.where("k = 7 OR k IS NULL")
            .groupBy(F.spark_partition_id())
            .count()
            .collect()
        )
        assert len(by_task) >= 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookup_join_on_either_side_of_the_limit(sides):
    left, right = sides
    assert fits_broadcast(right) and not fits_broadcast(right, 10)
    small = lookup_join(left, right, [("k", "rk")])
    large = lookup_join(left, right, [("k", "rk")], limit_bytes=10)
    assert rows_of(small) == rows_of(large)
