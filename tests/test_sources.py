import glob
import os

import pytest
from pyspark.sql import functions as F

from doorstep import schemas
from doorstep.sources import tables
from doorstep.sources.stage import materialise

from conftest import rows_of

WKT = "POLYGON((0 0,1 0,1 1,0 0))"


def test_raw_addresses(spark, folder):
    with open(f"{folder}/raw.csv", "w") as f:
        f.write('1,"1 High St, ""The Elms""",AB1 2CD,"SRID=4326;POINT(1 2)",R\n')
        f.write("2,Flat 3,AB1 2CE,,R\n")
    df = tables.read_raw_addresses(spark, f"{folder}/raw.csv")
    assert df.schema == schemas.RAW_ADDRESSES
    assert rows_of(df) == [
        ("1", '1 High St, "The Elms"', "AB1 2CD", "SRID=4326;POINT(1 2)", "R"),
        ("2", "Flat 3", "AB1 2CE", None, "R"),
    ]
    tables.write_raw_addresses(df, f"{folder}/again")
    assert rows_of(tables.read_raw_addresses(spark, f"{folder}/again")) == rows_of(df)


def test_ballots_keep_their_header_out_of_the_data(spark, folder):
    rows = [("local.a", "1", WKT, "Division"), ("none.b", None, None, "None"), ("q\"x,y", "2", None, "Division")]
    df = spark.createDataFrame(rows, schemas.BALLOTS).coalesce(1)
    tables.write_ballots(df, f"{folder}/ballots")
    name = glob.glob(f"{folder}/ballots/*.csv")[0]
    assert open(name).readline().strip() == "election_id,division_id,geometry,source_table"
    assert rows_of(tables.read_ballots(spark, f"{folder}/ballots")) == sorted(rows, key=repr)


def change(review, generation, kind, slug):
    row = ["s", "st", "ev", None, 'Order "1"', "2026-05-07", "c", "m", "o", "of", "g", "7", "u", slug, "n", None, WKT]
    return (*row, review, generation, kind)


def test_boundary_changes_by_folder(spark, folder):
    rows = [change(1, "old", "007", "a"), change(1, "new", "007", "b"), change(12, "old", "WAC", "c")]
    df = spark.createDataFrame(rows, schemas.BOUNDARY_CHANGES)
    tables.write_boundary_changes(df, f"{folder}/c")
    assert os.path.isdir(f"{folder}/c/boundary_review_id=1/divisionset_generation=old/division_type=007")
    back = tables.read_boundary_changes(spark, f"{folder}/c")
    assert back.schema == schemas.BOUNDARY_CHANGES  # 007 stays text, the id is an int
    assert rows_of(back) == sorted(rows, key=repr)


def test_folders_are_written_as_by_spark(spark, folder):
    texts = ["", None, " a ", 'q"x, y', "it's\\", '""', "é…", ",", "x" * 70_000]
    rows = [change(i % 3 or None, "old", kind, text) for i, text in enumerate(texts)
            for kind in ("007", None, "", 'a/b:{c}="%25 d"', "é[x]")]
    df = spark.createDataFrame(rows, schemas.BOUNDARY_CHANGES).repartition(3)
    keys = schemas.BOUNDARY_CHANGE_PARTITIONS
    df.coalesce(1).write.partitionBy(*keys).options(**tables.CSV_OPTIONS).csv(f"{folder}/spark")
    tables.write_boundary_changes(df, f"file:{folder}/own")
    tables.write_boundary_changes(df, f"{folder}/own")  # a rewrite leaves nothing behind

    def lines(path):
        held = {}
        for f in glob.glob(f"{path}/*/*/*/*.csv"):
            held.setdefault(os.path.dirname(f)[len(path):], []).extend(open(f, newline="").read().split("\n"))
        return {k: sorted(v) for k, v in held.items()}

    assert len(lines(f"{folder}/own")) == 12
    assert lines(f"{folder}/own") == lines(f"{folder}/spark")
    assert os.path.exists(f"{folder}/own/_SUCCESS")
    own, other = (rows_of(tables.read_boundary_changes(spark, f"{folder}/{p}")) for p in ("own", "spark"))
    assert own == other and len(own) == len(rows)


def test_small_files_are_read_by_few_tasks(spark, folder):
    rows = [change(i, "old", "WAC", "a") for i in range(300)]
    df = spark.createDataFrame(rows, schemas.BOUNDARY_CHANGES)
    tables.write_boundary_changes(df, f"{folder}/c")
    assert not glob.glob(f"{folder}/c/*/*/*/.*.crc")  # written by the tasks themselves
    before = spark.conf.get(tables.LISTING_TASKS)
    back = tables.read_boundary_changes(spark, f"{folder}/c")
    assert spark.conf.get(tables.LISTING_TASKS) == before
    assert back.rdd.getNumPartitions() <= tables.GATHERED * 8
    assert rows_of(back) == sorted(rows, key=repr)
    one = back.where("boundary_review_id = 7")
    assert one.count() == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "boundary_review_id" in plan.split("PartitionFilters")[1].split("]")[0]


def test_many_folders_are_read_in_parts(spark, folder, monkeypatch):
    rows = [change(i or None, "old", "007", "a") for i in range(11)]
    tables.write_boundary_changes(spark.createDataFrame(rows, schemas.BOUNDARY_CHANGES), f"{folder}/c")
    monkeypatch.setattr(tables, "FOLDERS_AT_ONCE", 4)
    for path in (f"{folder}/c", f"file:{folder}/c/"):
        back = tables.read_boundary_changes(spark, path)
        assert back.schema == schemas.BOUNDARY_CHANGES
        assert rows_of(back) == sorted(rows, key=repr)
    plan = back.where("boundary_review_id = 7")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("InMemoryFileIndex") == 3 and "boundary_review_id" in plan.split("PartitionFilters")[1].split("]")[0]


def test_a_write_that_fails_leaves_the_table(spark, folder):
    rows = [change(1, "old", "WAC", "a")]
    df = spark.createDataFrame(rows, schemas.BOUNDARY_CHANGES)
    tables.write_boundary_changes(df, f"{folder}/c")
    with pytest.raises(Exception):
        tables.write_boundary_changes(df.withColumn("slug", F.raise_error(F.lit("no"))), f"{folder}/c")
    assert rows_of(tables.read_boundary_changes(spark, f"{folder}/c")) == rows
    assert os.listdir(folder) == ["c"]


def test_no_changes_at_all(spark, folder):
    tables.write_boundary_changes(spark.createDataFrame([], schemas.BOUNDARY_CHANGES), f"{folder}/c")
    assert tables.read_boundary_changes(spark, f"{folder}/c").count() == 0


def test_by_letter(spark, folder):
    rows = [("A1", "1", "x", "A1 1", 1.0, 2.0, "s", "A"), ("B1", "2", "x", "B1 1", None, None, "s", "B"), (None, "3", "x", None, 1.0, 2.0, "s", None)]
    df = spark.createDataFrame(rows, schemas.ADDRESS_BASE)
    tables.write_by_letter(df, f"{folder}/b")
    tables.write_by_letter(df, f"{folder}/b")  # a rewrite leaves nothing behind
    back = tables.read_by_letter(spark, f"{folder}/b", schemas.ADDRESS_BASE)
    assert rows_of(back) == sorted(rows, key=repr)
    one = tables.read_by_letter(spark, f"{folder}/b", schemas.ADDRESS_BASE, ["B"])
    assert [r["uprn"] for r in one.collect()] == ["2"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "first_letter" in plan.split("PartitionFilters")[1].split("]")[0]
    assert glob.glob(f"{folder}/b/first_letter=A/*.snappy.parquet")


def test_catalog_table(spark, folder):
    rows = [("A1", "1", "x", "A1 1", 1.0, 2.0, "s", "A")]
    tables.write_by_letter(spark.createDataFrame(rows, schemas.ADDRESS_BASE), f"{folder}/b")
    table = tables.register_table(spark, "address_base_test", f"{folder}/b")
    try:
        assert table.where("first_letter = 'A'").count() == 1
    finally:
        spark.sql("DROP TABLE address_base_test")


def test_spread_only_touches_tables_in_few_splits(spark, folder):
    df = spark.range(100)
    df.coalesce(1).write.parquet(f"{folder}/one")
    df.repartition(8).write.parquet(f"{folder}/many")
    assert tables.spread(spark.read.parquet(f"{folder}/one")).rdd.getNumPartitions() == 8
    many = spark.read.option("maxPartitionBytes", 1).parquet(f"{folder}/many")
    spread = tables.spread(many)
    assert rows_of(spread) == rows_of(df)


def test_materialise_cuts_the_plan(spark):
    df = spark.range(10).selectExpr("id", "id % 3 AS k").distinct()
    kept = materialise(df, "test")
    assert rows_of(kept) == rows_of(df)
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()


def test_database_reader_takes_options():
    seen = {}

    class Reader:
        def format(self, name):
            seen["format"] = name
            return self

        def options(self, **values):
            seen.update(values)
            return self

        def load(self):
            return seen

    class Session:
        read = Reader()

    out = tables.read_database_table(
        Session, "jdbc:x", "t", {"user": "u"}, split_on="id", bounds=(1, 9), splits=4
    )
    assert out == {
        "format": "jdbc", "url": "jdbc:x", "dbtable": "t", "user": "u",
        "partitionColumn": "id", "lowerBound": 1, "upperBound": 9, "numPartitions": 4,
    }
