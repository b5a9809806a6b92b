import random

import pytest

from doorstep.operators.same_members import same_member_lists, same_members

from conftest import rows_of

SCHEMA = "g int, a string, b string, u string"


@pytest.mark.parametrize("seed", range(3))
def test_equals_list_comparison(spark, seed):
    rng = random.Random(seed)
    rows = []
    for g in range(20):
        members = [f"u{i}" for i in range(rng.randrange(1, 8))]
        for u in members:
            old, new = f"d{rng.randrange(3)}", f"d{rng.randrange(3)}"
            for _ in range(rng.choice([1, 1, 1, 2, 3])):
                rows.append((g, old, new, u))
            if rng.random() < 0.2:
                rows.append((g, f"d{rng.randrange(3)}", f"d{rng.randrange(3)}", u))
    df = spark.createDataFrame(rows, SCHEMA)
    got = rows_of(same_members(df, "a", "b", "u", ["g"]))
    assert got == rows_of(same_member_lists(df, "a", "b", "u", ["g"]))
    assert got


def test_counts_matter_not_only_members(spark):
    # b1 holds u1 twice through two old groups; a1 holds it once.
    df = spark.createDataFrame(
        [(1, "a1", "b1", "u1"), (1, "a2", "b1", "u1")], SCHEMA
    )
    assert rows_of(same_members(df, "a", "b", "u", ["g"])) == []


def test_missing_member_is_never_the_same(spark):
    df = spark.createDataFrame(
        [(1, "a", "b", "u1"), (1, "a", "b", None), (2, "a", "b", "u1")], SCHEMA
    )
    assert rows_of(same_members(df, "a", "b", "u", ["g"])) == [(2, "a", "b")]


def test_missing_group_name(spark):
    df = spark.createDataFrame(
        [(1, "a", None, "u1"), (1, None, "b", "u2"), (1, "c", "d", "u3")], SCHEMA
    )
    assert rows_of(same_members(df, "a", "b", "u", ["g"])) == [(1, "c", "d")]


def test_groups_stay_apart(spark):
    df = spark.createDataFrame(
        [(1, "a", "b", "u1"), (2, "a", "c", "u1"), (2, "a", "b", "u2")], SCHEMA
    )
    assert rows_of(same_members(df, "a", "b", "u", ["g"])) == [(1, "a", "b")]


def crowded(spark):
    """One member in many groups, and many groups of the same members under one key."""
    rows = [(1, f"a{i}", f"b{i}", "everyone") for i in range(40)]
    rows += [(1, f"a{i}", f"b{i}", f"own{i % 5}") for i in range(40)]
    return spark.createDataFrame(rows, SCHEMA)


def test_crowded_groups(spark):
    df = crowded(spark)
    got = same_members(df, "a", "b", "u", ["g"])
    assert rows_of(got) == rows_of(same_member_lists(df, "a", "b", "u", ["g"]))
    assert got.count() == 40 * 8


def test_no_window_and_no_lists(spark):
    plan = same_members(crowded(spark), "a", "b", "u", ["g"])._jdf.queryExecution().toString()
    assert "Window" not in plan and "collect_list" not in plan


def test_equal_hashes_are_compared_member_by_member(spark, monkeypatch):
    from pyspark.sql import functions as F

    from doorstep.operators import same_members as module

    whole = module._sums
    monkeypatch.setattr(
        module, "_sums", lambda held, within: whole(held, within).withColumns({"_h1": F.lit(0), "_h2": F.lit(0)})
    )
    rng = random.Random(9)
    rows = [(g, f"d{rng.randrange(4)}", f"d{rng.randrange(4)}", f"u{i}") for g in range(12) for i in range(5)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = rows_of(same_members(df, "a", "b", "u", ["g"]))
    assert got == rows_of(same_member_lists(df, "a", "b", "u", ["g"])) and got


def test_missing_keys_meet(spark):
    df = spark.createDataFrame([(None, "a", "b", "u1")], SCHEMA)
    assert rows_of(same_members(df, "a", "b", "u", ["g"])) == [(None, "a", "b")]


def test_rows_are_read_once(spark, folder):
    """The result reads the stored sums alone, and the rows are read by one job."""
    rows = [(g, f"d{i % 5}", f"e{i % 4}", f"u{i}") for g in range(6) for i in range(40)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/rows")
    stored = spark.read.schema(SCHEMA).parquet(f"{folder}/rows")
    plan = same_members(stored, "a", "b", "u", ["g"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") <= 4 and f"{folder}/rows" not in plan
    assert plan.count("Generate") == 0


def test_names_keep_their_type(spark):
    rows = [(1, 1, 2, "u"), (1, 3, 4, "v")]
    df = spark.createDataFrame(rows, "g int, a int, b int, u string")
    found = same_members(df, "a", "b", "u", ["g"])
    assert rows_of(found) == [(1, 1, 2), (1, 3, 4)] and found.schema["a"].dataType.simpleString() == "int"
