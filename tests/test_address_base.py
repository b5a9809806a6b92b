import pytest

from doorstep.plans.address_base import (
    build_address_base,
    of_letters,
    rejected_locations,
)

SCHEMA = "uprn string, address string, postcode string, location string, address_type string"


def row(postcode="AB1 2CD", location="SRID=4326;POINT(-1.5 52.25)"):
    return ("1", "1 High St", postcode, location, "R")


@pytest.mark.parametrize(
    "postcode, outcode, letter",
    [("AB1 2CD", "AB1", "A"), ("AB12CD", "AB12CD", "A"), ("", "", ""), (None, None, None), (" X", "", " ")],
)
def test_postcode_parts(spark, postcode, outcode, letter):
    out = build_address_base(spark.createDataFrame([row(postcode)], SCHEMA), "s").first()
    assert (out["outcode"], out["first_letter"]) == (outcode, letter)
    assert out["addressbase_source"] == "s"


@pytest.mark.parametrize(
    "location, x, y",
    [
        ("SRID=4326;POINT(-1.5 52.25)", -1.5, 52.25),
        ("SRID=4326;POINT (1e1 -2.5E-1)", 10.0, -0.25),
        ("SRID=4326;point( 1  2 )", 1.0, 2.0),
        ("SRID=4326;POINT Z (1 2 3)", 1.0, 2.0),
        ("SRID=4326;POINT EMPTY", None, None),
        ("SRID=4326;POINT(1 2", None, None),
        ("SRID=4326;POINT(1-2 3)", None, 3.0),
        ("POINT(1 2)", None, None),
        ("", None, None),
        (None, None, None),
    ],
)
def test_point(spark, location, x, y):
    out = build_address_base(spark.createDataFrame([row(location=location)], SCHEMA), "s").first()
    assert (out["longitude"], out["latitude"]) == (x, y)


def test_strict_and_rejects(spark):
    df = spark.createDataFrame([row(), row(location="SRID=1;nonsense"), row(location=None)], SCHEMA)
    assert rejected_locations(df).count() == 1
    with pytest.raises(Exception, match="not a point: nonsense"):
        build_address_base(df, "s", strict=True).collect()


def test_letters(spark):
    df = build_address_base(spark.createDataFrame([row("A1 1"), row("B1 1"), row(None)], SCHEMA), "s")
    assert of_letters(df).count() == 3
    assert of_letters(df, ["A"]).count() == 1
