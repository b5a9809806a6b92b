"""Updates from changes alone against the full computation."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from doorstep.operators import content_sums as sums
from doorstep.operators.contains import Touched, contains_join, contains_update
from doorstep.plans import elections

from conftest import rows_of

SF = "/root/testdata/sf0.001"
POINTS = "u string, longitude double, latitude double"


def box(x, y, w, h):
    return f"POLYGON(({x} {y},{x + w} {y},{x + w} {y + h},{x} {y + h},{x} {y}))"


def scene(spark, seed):
    rng = random.Random(seed)
    points = [(f"u{i % 90}", rng.uniform(0, 8), rng.uniform(0, 8)) for i in range(300)]
    points += [("none", None, None), (None, 1.0, 1.0), ("edge", 2.0, 2.0)]
    areas = [(f"a{i % 12}", box(rng.randrange(8), rng.randrange(8), rng.choice([0.5, 1, 3]), 1)) for i in range(20)]
    areas += [("no outline", None), areas[0]]
    return spark.createDataFrame(points, POINTS), areas


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("change", ["moved", "gone", "come", "renamed", "repeated", "nothing", "all"])
def test_join_after_a_change(spark, how, change):
    points, areas = scene(spark, 5)
    other = {
        "moved": [*areas[1:], ("a0", box(6.25, 6.25, 1, 1))],
        "gone": areas[2:],
        "come": [*areas, ("new", box(0, 0, 5, 5))],
        "renamed": [("b", areas[1][1]), areas[0], *areas[2:]],
        "repeated": [*areas, areas[3]],
        "nothing": areas[::-1],
        "all": [],
    }[change]
    before, after = (spark.createDataFrame(a, "area string, geometry string") for a in (areas, other))
    found = contains_join(points, before, how=how)
    got = contains_update(found, points, before, after, how=how)
    assert rows_of(got) == rows_of(contains_join(points, after, how=how))


def test_only_points_near_a_change_are_joined_again(spark):
    points = spark.range(10000).select(
        F.col("id").cast("string").alias("u"), (F.col("id") % 100 + 0.5).alias("longitude"),
        (F.floor(F.col("id") / 100) + 0.5).alias("latitude"),
    )
    areas = [(f"{x}-{y}", box(x, y, 10, 10)) for x in range(0, 100, 10) for y in range(0, 100, 10)]
    before = spark.createDataFrame(areas, "area string, geometry string")
    after = spark.createDataFrame([("0-0", box(0, 0, 5, 10)), *areas[1:]], before.schema)
    touched = Touched(before, after)
    assert 100 <= touched.inside(points).count() < 300
    assert touched.inside(points).count() + touched.outside(points).count() == 10000


def test_layer_with_repeated_addresses(spark):
    base = entry._base(spark, SF)
    # one address with two places, and one without any field
    base = base.unionAll(base.where("uprn = '7'").withColumn("longitude", F.col("longitude") + 1))
    base = base.unionAll(base.where("uprn = '3'").withColumns({c: F.lit(None).cast("string") for c in ("uprn", "address", "postcode", "first_letter")}))
    after = entry._ballots(spark, SF)
    before = entry._derive(spark, SF, entry.fx.BALLOTS_BEFORE)
    layer = elections.ballots_by_address(base, before)
    assert rows_of(layer) != rows_of(elections.ballots_by_address(base, after))
    got = elections.update_ballots(base, layer, before, after)
    assert rows_of(got) == rows_of(elections.ballots_by_address(base, after))


def one(df):
    return tuple(df.first())


def test_sums_add_up(spark):
    rows = [(i % 4, f"k{i}", None if i % 5 else "x", [i]) for i in range(60)]
    df = spark.createDataFrame(rows, "g int, k string, v string, l array<int>")
    whole = one(sums.content_sums(df))
    parts = sums.content_sums(df, ["g"])
    assert one(sums.merged((parts.drop("g"), 1))) == whole
    left, gone = df.where("g > 0"), df.where("g = 0")
    assert one(sums.merged((sums.content_sums(df), 1), (sums.content_sums(gone), -1))) == one(sums.content_sums(left))
    assert one(sums.content_sums(df.repartition(7))) == whole
    assert one(sums.content_sums(df.where("false"))) == (0, 0, 0)
    # where a null stands matters, and repeats count
    two = spark.createDataFrame([("a", None)], "x string, y string"), spark.createDataFrame([(None, "a")], "x string, y string")
    assert one(sums.content_sums(two[0])) != one(sums.content_sums(two[1]))
    assert one(sums.content_sums(two[0].unionAll(two[0])))[1] == 2 * one(sums.content_sums(two[0]))[1] % sums.PRIME


def test_changes_of_distinct_keys(spark):
    keys = lambda *values: spark.createDataFrame([(v,) for v in values], "uprn string")
    before = keys("a", "a", "b", "c", None)
    came, went = sums.key_change(before, keys("a", "b", "x", None), keys("d", "d", "c", "b", None))
    assert rows_of(came) == [("d",)] and rows_of(went) == []
    came, went = sums.key_change(before, keys("a", "a", "c"), keys())
    assert rows_of(came) == [] and rows_of(went) == [("a",), ("c",)]


@pytest.mark.parametrize("seed", range(3))
def test_sums_follow_a_table(spark, seed):
    rng = random.Random(seed)
    table = [rng.choice("abcdefgh") for _ in range(12)]
    gone = rng.sample(table, 5)
    come = [rng.choice("abcdefghij") for _ in range(6)]
    after = list(table)
    for k in gone:
        after.remove(k)
    after += come
    frame = lambda values: spark.createDataFrame([(v,) for v in values], "uprn string")
    came, went = sums.key_change(frame(table), frame(gone), frame(come))
    got = sums.merged((sums.distinct_key_sums(frame(table)), 1), (sums.key_sums(came), 1), (sums.key_sums(went), -1))
    assert one(got) == one(sums.distinct_key_sums(frame(after)))
    check = sums.sums_check(got, sums.key_sums(frame(sorted(set(after))))).first()
    assert check.match_status == "match" and check.source_distinct_count == len(set(after))
    repeated = sums.sums_check(got, sums.key_sums(frame([*sorted(set(after)), after[0]]))).first()
    assert repeated.match_status == "mismatch"
