import datetime
import json

from doorstep import schemas
from doorstep.plans import reviews

from conftest import rows_of


def day(n):
    return datetime.date(2020, 1, n)


def test_current_divisionset(spark):
    sets = spark.createDataFrame(
        [
            (1, 10, day(1)), (2, 10, day(3)), (3, 10, None),  # nulls last
            (5, 20, day(2)), (4, 20, day(2)),  # a tie goes to the lowest id
            (7, 30, None), (6, 30, None),
        ],
        "id long, organisation_id long, end_date date",
    )
    assert rows_of(reviews.current_divisionsets(sets)) == [(10, 2), (20, 4), (30, 6)]


def export(spark, review_rows, set_rows, **options):
    def df(rows, schema):
        return spark.createDataFrame(rows, schema)

    sets = [s[0] for s in set_rows]
    return reviews.boundary_changes(
        reviews=df(
            [(i, o, "r", "st", "ev", None, "t", day(1), day(2), day(3), new) for i, o, new in review_rows],
            "id long, organisation_id long, slug string, status string, latest_event string,"
            " consultation_url string, legislation_title string, effective_date date,"
            " created date, modified date, divisionset_id long",
        ),
        organisations=df([(1, "One", "one", "One Council"), (2, "Two", "two", "Two Council")], "id long, common_name string, slug string, official_name string"),
        organisation_geographies=df([(1, "E1"), (2, "E2"), (2, "E2b")], "organisation_id long, gss string"),
        divisionsets=df(set_rows, "id long, organisation_id long, end_date date, pmtiles_md5_hash string"),
        divisions=df([(s * 10, s, f"w{s}", f"W{s}", None, "WAC") for s in sets], "id long, divisionset_id long, slug string, name string, official_identifier string, division_type string"),
        division_geographies=df([(s * 100, s * 10) for s in sets], "id long, division_id long"),
        division_pieces=df([(s * 100, f"P{s}") for s in sets], "division_geography_id long, geography string"),
        tiles_url="https://tiles.example/",
        **options,
    )


def test_export_generations_and_url(spark):
    out = export(spark, [(963, 1, 12)], [(11, 1, day(1), "h"), (12, 1, None, None), (13, 1, None, "x")])
    got = rows_of(out.select("divisionset_generation", "divisionset_id", "divisionset_pmtiles_url", "boundary_review_id"))
    assert got == [
        ("new", "12", "https://tiles.example/one_12_.pmtiles", 963),
        ("old", "11", "https://tiles.example/one_11_h.pmtiles", 963),
    ]
    assert sorted(out.columns) == sorted(schemas.BOUNDARY_CHANGES.fieldNames())


def test_export_same_set_is_old_once(spark):
    out = export(spark, [(1, 1, 11)], [(11, 1, day(1), "h")])
    assert [r["divisionset_generation"] for r in out.collect()] == ["old"]


def test_export_fans_out_over_organisation_geographies(spark):
    out = export(spark, [(1, 2, 22)], [(21, 2, day(1), "h"), (22, 2, None, "h")])
    assert out.count() == 4


def test_export_without_current_set_and_filter(spark):
    sets = [(11, 1, day(1), "h"), (99, 7, None, "h")]
    out = export(spark, [(1, 2, 99), (2, 1, 11)], sets)
    assert rows_of(out.select("boundary_review_id", "divisionset_generation")) == [
        (1, "new"), (1, "new"), (2, "old"),
    ]
    assert export(spark, [(1, 2, 99), (2, 1, 11)], sets, review_ids=[2]).count() == 1
    assert rows_of(reviews.review_pairs(out)) == [(1, "WAC"), (2, "WAC")]


def square(x, y, w=1, h=1):
    return f"POLYGON(({x} {y},{x + w} {y},{x + w} {y + h},{x} {y + h},{x} {y}))"


def change(review, generation, slug, wkt, kind="WAC", url="http://c"):
    return (
        "s", "st", "ev", url, 'Act "A"', "2026-05-07", "c", "m", "Org", "Org Council", "E1", "7",
        f"tiles-{generation}", slug, f"{slug} {generation}", None, wkt, review, generation, kind,
    )


def changes(spark, rows):
    return spark.createDataFrame([change(*r) for r in rows], schemas.BOUNDARY_CHANGES)


def addresses(spark, rows):
    return spark.createDataFrame(
        [(u, f"addr {u}", "AA1 1AA", "src", "A", x, y) for u, x, y in rows],
        "uprn string, address string, postcode string, addressbase_source string,"
        " first_letter string, longitude double, latitude double",
    )


ROWS = [
    # kept as it is
    (1, "old", "a", square(0, 0)), (1, "new", "a", square(0, 0)),
    # renamed only
    (1, "old", "b", square(2, 0)), (1, "new", "b2", square(2, 0)),
    # a part of c moves to d
    (1, "old", "c", square(4, 0, 2)), (1, "new", "c", square(4, 0)),
    (1, "old", "d", square(6, 0)), (1, "new", "d", square(5, 0, 2)),
    # another review, of another type, with only an old side here
    (2, "old", "z", square(0, 0), "CED"),
    # a division without a slug
    (3, "old", None, square(8, 0)), (3, "new", None, square(8, 0)),
]
POINTS = [("1", 0.5, 0.5), ("2", 2.5, 0.5), ("3", 4.5, 0.5), ("4", 5.5, 0.5), ("5", 6.5, 0.5), ("6", 8.5, 0.5), ("7", 20.0, 0.5)]


def test_scenarios(spark):
    out = reviews.address_scenarios(addresses(spark, POINTS), changes(spark, ROWS))
    got = {(r["uprn"], r["boundary_review_id"]): r["change_scenario"] for r in out.collect()}
    assert got == {
        ("1", 1): "NO_CHANGE",
        ("2", 1): "NAME_CHANGED",
        ("3", 1): "BOUNDARY_CHANGED",
        ("4", 1): "BOTH_CHANGED",
        ("5", 1): "BOUNDARY_CHANGED",
        ("6", 3): "BOTH_CHANGED",
    }


def test_pieces_of_one_division_count_together(spark):
    rows = [
        (1, "old", "a", square(0, 0)), (1, "old", "a", square(1, 0)),
        (1, "new", "a", square(0, 0, 2)),
    ]
    out = reviews.address_scenarios(
        addresses(spark, [("1", 0.5, 0.5), ("2", 1.5, 0.5)]), changes(spark, rows)
    )
    assert {r["change_scenario"] for r in out.collect()} == {"NO_CHANGE"}


def test_details(spark):
    base = addresses(spark, POINTS[:1])
    out = reviews.address_changes(base, changes(spark, ROWS))
    assert [f.name for f in out.schema] == schemas.ADDRESS_CHANGES.fieldNames()
    row = out.first()
    assert row["boundary_change_details"] == {
        "division_type": "WAC",
        "old_division_slug": "a", "old_division_name": "a old",
        "old_division_official_identifier": None, "old_divisionset_pmtiles_url": "tiles-old",
        "new_division_slug": "a", "new_division_name": "a new",
        "new_division_official_identifier": None, "new_divisionset_pmtiles_url": "tiles-new",
        "change_scenario": "NO_CHANGE",
    }
    assert row["boundary_review_details"]["legislation_title"] == 'Act "A"'


def test_reviews_by_address(spark):
    rows = [
        (10, "old", "a", square(0, 0), "WAC", None), (10, "new", "a", square(0, 0), "WAC", None),
        (10, "old", "a", square(0, 0), "CED", None), (10, "new", "a", square(0, 0), "CED", None),
        (9, "old", "k", square(0, 0)), (9, "new", "k", square(0, 0)),
    ]
    base = addresses(spark, [("1", 0.5, 0.5), ("2", 9.0, 9.0), (None, 0.5, 0.5)])
    out = reviews.reviews_by_address(base, reviews.address_changes(base, changes(spark, rows)))
    assert [f.name for f in out.schema] == schemas.REVIEWS_BY_ADDRESS.fieldNames()
    got = {r["uprn"]: r["boundary_reviews"] for r in out.collect()}
    assert got["2"] == [] and got[None] == []
    first, second = [json.loads(t) for t in got["1"]]
    assert [first["boundary_review_id"], second["boundary_review_id"]] == [9, 10]
    assert [c["division_type"] for c in second["changes"]] == ["CED", "WAC"]
    assert list(first) == ["boundary_review_id", "boundary_review_details", "changes"]
    assert list(first["changes"][0]) == sorted(reviews.CHANGE_KEYS)
    assert second["boundary_review_details"]["consultation_url"] is None
    # an address without a uprn makes its division unlike any other
    assert first["changes"][0]["change_scenario"] == "BOUNDARY_CHANGED"


def test_repeated_address_rows_repeat_entries(spark):
    base = addresses(spark, [("1", 0.5, 0.5), ("1", 0.5, 0.5)])
    found = reviews.address_changes(base, changes(spark, ROWS[:2]))
    lists = reviews.review_lists(found).first()["boundary_reviews"]
    assert len(json.loads(lists[0])["changes"]) == 2
    assert reviews.reviews_by_address(base, found).count() == 2
