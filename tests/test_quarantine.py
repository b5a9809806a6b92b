import pytest

from doorstep import schemas
from doorstep.plans import layers
from doorstep.sources import quarantine

from conftest import rows_of

LINES = [
    '1,"Flat 1, High St",A1 1AA,SRID=4326;POINT(1 2),t',
    '2,"He said ""no"", twice",A1 1AA,SRID=4326;POINT(1 2),t',
    "3,x,A1 1AA,SRID=4326;POINT(1 2)",
    "4,x,A1 1AA,SRID=4326;POINT(1 2),t,more,\"and, more\"",
    '5,"x,A1 1AA,SRID=4326;POINT(1 2),t',
    "6,x,A1 1AA,SRID=4326;POINT(nowhere),t",
    "7,,,,",
    "8",
    "é,ü,A1 1AA,SRID=4326;POINT(1 2),t",
]
REASONS = {"3": "few fields", "4": "many fields", "5": "open quote", "6": "location", "8": "few fields"}


@pytest.fixture
def path(folder):
    with open(f"{folder}/lines.csv", "w") as f:
        f.write("\n".join(LINES) + "\n")
    return f"{folder}/lines.csv"


def test_every_line_is_a_row_or_set_aside(spark, path):
    scanned = quarantine.scan_raw_addresses(spark, path)
    rejected = {r.line.strip('{"uprn:')[0] if r.reason == "location" else r.line[0]: r for r in quarantine.rejected_lines(scanned).collect()}
    assert {k: r.reason for k, r in rejected.items()} == REASONS
    assert all(r.file.endswith("/lines.csv") for r in rejected.values())
    assert all(rejected[line[0]].line == line for line in LINES if REASONS.get(line[0], "location") != "location")
    good = rows_of(quarantine.good_addresses(scanned))
    assert [r[0] for r in good] == ["1", "2", "7", "é"] and good[1][1] == 'He said "no", twice'
    assert len(good) + len(rejected) == len(LINES) == scanned.count()


def test_an_empty_file(spark, folder):
    open(f"{folder}/none.csv", "w").close()
    scanned = quarantine.scan_raw_addresses(spark, f"{folder}/none.csv")
    assert scanned.count() == 0 and quarantine.rejected_lines(scanned).count() == 0


def test_lines_set_aside_refuse_the_layer_or_are_published_with_it(spark, path, folder, caplog):
    with pytest.raises(layers.RejectedLocations, match="2 lines have few fields"):
        layers.bake_address_base(spark, path, f"{folder}/out")
    base = layers.bake_address_base(spark, path, f"{folder}/out", allow_rejected=True)
    assert sorted(r.uprn for r in base.collect()) == ["1", "2", "6", "7", "é"]
    aside = spark.read.parquet(layers.table(f"{folder}/out", layers.ADDRESS_BASE, "rejected_lines"))
    assert sorted(r.reason for r in aside.collect()) == sorted(REASONS.values())
    assert "1 lines have open quote" in caplog.text
    assert base.schema.fieldNames() == schemas.ADDRESS_BASE.fieldNames()
