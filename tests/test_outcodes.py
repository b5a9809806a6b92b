import glob
import os

import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from doorstep.plans import outcodes

from conftest import rows_of

SCHEMA = "uprn string, postcode string, ballot_ids array<string>"


def layer(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def units(path):
    return sorted(
        os.path.basename(p).split("=")[1] for p in glob.glob(f"{path}/unit=*")
    )


def unit_rows(path, outcode):
    """The rows of a unit, its files in name order."""
    out = []
    for name in sorted(glob.glob(f"{path}/unit={outcode}/*.parquet")):
        out += pq.ParquetFile(name).read().to_pylist()
    return out


def test_unit_is_sorted(spark, folder):
    rows = [("4", "AA1 1BB", []), ("3", "AA1 1BB", ["b1"]), ("1", "AA1 1AA", ["b2"]), ("2", "AA1 1AA", ["b3"])]
    path = f"{folder}/units"
    outcodes.write_outcodes(layer(spark, rows), path, "ballot_ids")
    found = unit_rows(path, "AA1")
    assert [r["uprn"] for r in found] == ["1", "2", "3", "4"]
    assert [r["ballot_ids"] for r in found] == [["b2"], ["b3"], ["b1"], []]
    assert [r["postcode"] for r in found] == ["AA1 1AA", "AA1 1AA", "AA1 1BB", "AA1 1BB"]
    assert {r["outcode"] for r in found} == {"AA1"}


def test_outcode_without_data_has_no_unit_but_an_index_row(spark, folder):
    rows = [
        ("1", "AA1 1AA", ["b"]), ("2", "AA1 1AA", None),
        ("3", "BB1 1AA", []), ("4", "BB1 1AB", None), ("5", "BB1 1AB", [None]),
        (None, "CC1 1AA", ["b"]), ("6", None, ["b"]),
    ]
    path = f"{folder}/units"
    index = outcodes.write_outcodes(layer(spark, rows), path, "ballot_ids")
    assert rows_of(index) == sorted(
        [("AA1", 2, True), ("BB1", 3, False), ("CC1", 1, True), (None, 1, True)], key=repr
    )
    assert units(path) == ["AA1", "CC1", "__HIVE_DEFAULT_PARTITION__"]
    back = outcodes.read_outcodes(spark, path, layer(spark, []).schema)
    assert rows_of(back.select("uprn", "outcode")) == sorted(
        [("1", "AA1"), ("2", "AA1"), (None, "CC1"), ("6", None)], key=repr
    )


def test_large_outcode_becomes_several_files_in_order(spark, folder):
    rows = [(f"{i:05d}", f"AA1 {i % 90:02d}A", ["b"]) for i in range(2000)]
    rows += [(f"z{i}", f"BB{i} 1AA", ["b"]) for i in range(20)]
    path = f"{folder}/units"
    outcodes.write_outcodes(layer(spark, rows), path, "ballot_ids", rows_per_file=300)
    assert len(glob.glob(f"{path}/unit=AA1/*.parquet")) > 3
    found = [(r["postcode"], r["uprn"]) for r in unit_rows(path, "AA1")]
    assert found == sorted((p, u) for u, p, _ in rows if p.startswith("AA1"))
    assert len(units(path)) == 21


def test_refresh_replaces_and_removes_units(spark, folder):
    path = f"{folder}/units"
    old = [("1", "A1 1AA", ["b"]), ("2", "A11 1AA", ["b"]), ("3", "C1 1AA", ["b"])]
    outcodes.write_outcodes(layer(spark, old), path, "ballot_ids")
    new = [("2", "A11 1AA", ["c"]), ("3", "C1 1AA", []), ("4", "D1 1AA", ["b"])]
    outcodes.write_outcodes(layer(spark, new), path, "ballot_ids", refresh=True)
    left = outcodes.read_outcodes(spark, path, layer(spark, []).schema)
    assert rows_of(left.select("uprn", "ballot_ids")) == [("2", ["c"]), ("4", ["b"])]
    assert unit_rows(path, "A11")[0]["ballot_ids"] == ["c"]


def test_refresh_removes_the_default_unit(spark, folder):
    path = f"{folder}/units"
    old = [("1", "A1 1AA", ["b"]), ("8", "", ["b"]), ("9", None, ["b"])]
    outcodes.write_outcodes(layer(spark, old), path, "ballot_ids")
    read = lambda: outcodes.read_outcodes(spark, path, layer(spark, []).schema)
    assert rows_of(read().select("uprn", "outcode")) == sorted([("1", "A1"), ("8", ""), ("9", None)], key=repr)
    keys = spark.createDataFrame([("", "8"), (None, "9"), ("A1", "1")], "outcode string, uprn string")
    found = {r.uprn: r.ballot_ids for r in outcodes.lookup(read(), keys, "ballot_ids").collect()}
    assert found == {"8": ["b"], "9": [], "1": ["b"]}
    outcodes.write_outcodes(layer(spark, old[:1]), path, "ballot_ids", refresh=True)
    assert rows_of(read().select("uprn", "outcode")) == [("1", "A1")]


def test_small_outcodes_are_one_file_each(spark, folder):
    rows = [(f"{o}-{i}", f"U{o} {i:03d}", ["b"]) for o in range(40) for i in range(50)]
    path = f"{folder}/units"
    outcodes.write_outcodes(layer(spark, rows).repartition(7), path, "ballot_ids", rows_per_file=500)
    assert len(units(path)) == 40
    for o in range(40):
        assert len(glob.glob(f"{path}/unit=U{o}/*.parquet")) == 1
        found = unit_rows(path, f"U{o}")
        assert found == [
            {"uprn": f"{o}-{i}", "postcode": f"U{o} {i:03d}", "ballot_ids": ["b"], "outcode": f"U{o}"}
            for i in range(50)
        ]


def outcode_frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "outcode string")


def postcode_frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "postcode string")


@pytest.mark.parametrize(
    "target, source, stale",
    [
        (["A1", "A1", "B2"], ["A1 1AA", "C3 1AA"], ["B2"]),
        (["A1", None], ["B2 1AA"], ["A1"]),
        (["A1", "B2"], ["A1 1AA", None], []),
        (["A1", None], [], ["A1", None]),
        (["A1"], ["A1"], []),
    ],
)
def test_stale(spark, target, source, stale):
    out = outcodes.stale_outcodes(outcode_frame(spark, target), postcode_frame(spark, source))
    assert rows_of(out) == sorted([(v,) for v in stale], key=repr)


def test_remove_stale_takes_exact_outcodes(spark, folder):
    path = f"{folder}/units"
    rows = [("1", "A1 1AA", ["b"]), ("2", "A11 1AA", ["b"]), ("3", "Q/1 1AA", ["b"])]
    outcodes.write_outcodes(layer(spark, rows), path, "ballot_ids")
    removed = outcodes.remove_stale_outcodes(
        spark, path, postcode_frame(spark, ["A11 9ZZ", None])
    )
    assert rows_of(removed) == [("A1", 1), ("Q/1", 1)]
    left = outcodes.read_outcodes(spark, path, layer(spark, []).schema)
    assert rows_of(left.select("uprn", "outcode")) == [("2", "A11")]


def test_lookup(spark, folder):
    path = f"{folder}/units"
    rows = [("1", "A1 1AA", ["b", "c"]), ("2", "A1 1AA", []), ("3", "B1 1AA", ["d"])]
    outcodes.write_outcodes(layer(spark, rows), path, "ballot_ids")
    stored = outcodes.read_outcodes(spark, path, layer(spark, []).schema)
    keys = spark.createDataFrame(
        [("A1", "1"), ("A1", "2"), ("A1", "9"), ("B1", "3"), ("B1", "3"), ("X", "1")],
        "outcode string, uprn string",
    )
    out = outcodes.lookup(stored, keys, "ballot_ids")
    assert rows_of(out) == sorted([
        ("A1", "1", ["b", "c"]), ("A1", "2", []), ("A1", "9", []),
        ("B1", "3", ["d"]), ("B1", "3", ["d"]), ("X", "1", []),
    ], key=repr)


@pytest.mark.parametrize("asked", [1, 1500])
def test_lookup_prunes_folders(spark, folder, asked):
    path = f"{folder}/units"
    outcodes.write_outcodes(
        layer(spark, [(str(i), f"A{i} 1AA", ["b"]) for i in range(8)]), path, "ballot_ids"
    )
    stored = outcodes.read_outcodes(spark, path, layer(spark, []).schema)
    keys = spark.createDataFrame(
        [("A3", "3")] + [(f"X{i}", "1") for i in range(asked - 1)], "outcode string, uprn string"
    )
    plan = outcodes.lookup(stored, keys, "ballot_ids")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def file_times(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/unit=*/*.parquet")}


def test_refresh_writes_changed_units_only(spark, folder):
    path = f"{folder}/units"
    old = [(str(i), f"{'ABCDE'[i % 5]}{i % 3} {i % 7}AA", ["b"]) for i in range(150)]
    outcodes.write_outcodes(layer(spark, old), path, "ballot_ids")
    before = file_times(path)
    new = [r for r in old if not r[1].startswith("A1 ")]  # a unit goes
    new = [(u, p, ["c"] if u == "7" else b) for u, p, b in new]  # a row of C1 changes
    new += [("900", "Z9 1AA", ["b"])]  # a unit comes
    new.reverse()  # the order of rows is no change
    outcodes.write_outcodes(layer(spark, new), path, "ballot_ids", refresh=True)
    after = file_times(path)
    changed = {f.split("unit=")[1].split("/")[0] for f in set(before.items()) ^ set(after.items())}
    assert changed == {"A1", "C1", "Z9"} and len(set(before.items()) & set(after.items())) == 13
    read = outcodes.read_outcodes(spark, path, layer(spark, []).schema)
    assert rows_of(read.select("uprn", "postcode", "ballot_ids")) == sorted(new, key=repr)
    # nothing changed: nothing is written
    outcodes.write_outcodes(layer(spark, new), path, "ballot_ids", refresh=True)
    assert file_times(path) == after


def test_a_refresh_that_ended_half_way_is_mended_by_the_next(spark, folder, monkeypatch):
    path = f"{folder}/units"
    first = [("1", "A1 1AA", ["b"]), ("2", "B1 1AA", ["b"])]
    second = [("1", "A1 1AA", ["c"]), ("2", "B1 1AA", ["b"])]
    outcodes.write_outcodes(layer(spark, first), path, "ballot_ids")
    with monkeypatch.context() as broken:
        broken.setattr(outcodes, "_remove_units", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            outcodes.write_outcodes(layer(spark, second), path, "ballot_ids", refresh=True)
    # the files of A1 are new, and going back to the first rows has to write them again
    outcodes.write_outcodes(layer(spark, first), path, "ballot_ids", refresh=True)
    read = outcodes.read_outcodes(spark, path, layer(spark, []).schema)
    assert rows_of(read.select("uprn", "postcode", "ballot_ids")) == first


def test_a_deletion_that_fails_is_reported(spark, folder):
    path = f"{folder}/units"
    outcodes.write_outcodes(layer(spark, [("1", "A1 1AA", ["b"]), ("2", "B1 1AA", ["b"])]), path, "ballot_ids")
    for name in glob.glob(f"{path}/unit=B1/*.parquet"):
        data = open(name, "rb").read()
        os.remove(name)
        os.mkdir(name)  # no file: it cannot be deleted as one
        open(f"{name}/{os.path.basename(name)}", "wb").write(data)
    rows = [("B1", name, "") for name in glob.glob(f"{path}/unit=B1/*.parquet")]
    report = outcodes._deleted([pd.DataFrame(rows, columns=["unit", "path", "error"])])
    assert all(e for batch in report for e in batch["error"])
    gone = [pd.DataFrame([("B1", f"{path}/none.parquet")], columns=["unit", "path"])]
    assert [list(b["error"]) for b in outcodes._deleted(gone)] == [[None]]


def test_stale_units_that_stay_raise(spark, folder, monkeypatch):
    path = f"{folder}/units"
    outcodes.write_outcodes(layer(spark, [("1", "A1 1AA", ["b"]), ("2", "B1 1AA", ["b"])]), path, "ballot_ids")

    def failing(batches):
        for batch in batches:
            yield batch.assign(error="PermissionError: no")

    monkeypatch.setattr(outcodes, "_deleted", failing)
    with pytest.raises(outcodes.StaleUnitsLeft, match="1 files .*B1.*PermissionError"):
        outcodes.remove_stale_outcodes(spark, path, postcode_frame(spark, ["A1 1AA"]))
