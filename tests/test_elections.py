import datetime

from pyspark.sql import functions as F

import __spark_entry__ as entry
from doorstep import schemas
from doorstep.plans import elections

from conftest import rows_of

EARLY, LATE = datetime.date(2026, 1, 1), datetime.date(2026, 6, 1)
PIECE = "POLYGON((0 0,1 0,1 1,0 1,0 0))"


def literal(status, group, date, current):
    """The rule in its long form, with SQL's three truth values."""
    def both(a, b):
        return False if a is False or b is False else (None if a is None or b is None else True)

    def either(a, b):
        return True if a is True or b is True else (None if a is None or b is None else False)

    def negated(a):
        return None if a is None else not a

    polled = None if date is None else date >= datetime.date(2026, 3, 1)
    kept = both(
        both(status == "Approved", either(polled, current)),
        both(negated(both(negated(current), current is not None)), group is None),
    )
    return kept is True


def test_every_case_of_the_filter(spark):
    cases = [
        (status, group, date, current)
        for status in ("Approved", "Suggested")
        for group in (None, "organisation")
        for date in (EARLY, LATE, None)
        for current in (True, False, None)
    ]
    rows = [(str(i), s, d, c, g, None, None) for i, (s, g, d, c) in enumerate(cases)]
    df = spark.createDataFrame(rows, schemas.ELECTIONS)
    kept = {r["election_id"] for r in df.where(elections.is_current("2026-03-01")).collect()}
    assert kept == {str(i) for i, c in enumerate(cases) if literal(*c)}


def test_default_cutoff_is_thirty_days_ago(spark):
    today = datetime.date.today()
    rows = [
        (str(n), "Approved", today - datetime.timedelta(days=n), None, None, None, None)
        for n in (29, 31)
    ]
    df = spark.createDataFrame(rows, schemas.ELECTIONS)
    kept = [r["election_id"] for r in df.where(elections.is_current(None)).collect()]
    assert kept == ["29"]


def test_area_choice(spark):
    rows = [
        ("both", "Approved", LATE, None, None, 1, 1),
        ("division", "Approved", LATE, None, None, 1, None),
        ("organisation", "Approved", LATE, None, None, None, 1),
        ("none", "Approved", LATE, None, None, 9, None),
    ]
    out = elections.current_ballots(
        spark.createDataFrame(rows, schemas.ELECTIONS),
        spark.createDataFrame([(11, 1, "D1"), (12, 1, "D2")], "id long, division_geography_id long, geography string"),
        spark.createDataFrame([(21, 1, "O1")], "id long, organisation_geography_id long, geography string"),
        "2026-03-01",
    )
    assert rows_of(out) == sorted([
        ("both", "11", "D1", "Organisation"),
        ("both", "12", "D2", "Organisation"),
        ("division", "11", "D1", "Division"),
        ("division", "12", "D2", "Division"),
        ("organisation", "21", "O1", "Organisation"),
        ("none", None, None, "None"),
    ], key=repr)


def addresses(spark, rows):
    return spark.createDataFrame(
        rows,
        "uprn string, address string, postcode string, addressbase_source string,"
        " first_letter string, longitude double, latitude double",
    )


def ballots(spark, rows):
    return spark.createDataFrame(rows, schemas.BALLOTS)


def test_ballot_lists(spark):
    base = addresses(spark, [
        ("1", "a", "AA1 1AA", "v", "A", 0.5, 0.5),
        ("2", "a", "AA1 1AA", "v", "A", 5.0, 5.0),
        ("3", "a", "AA1 1AA", "v", "A", None, None),
        # copies of one address in two places are one address with both lists
        ("4", "a", "AA1 1AA", "v", "A", 0.5, 0.5),
        ("4", "a", "AA1 1AA", "v", "A", 2.5, 0.5),
    ])
    areas = ballots(spark, [
        ("b", "1", PIECE, "Division"),
        ("a", "2", PIECE, "Organisation"),
        ("b", "3", PIECE, "Organisation"),
        ("c", "4", "POLYGON((2 0,3 0,3 1,2 1,2 0))", "Division"),
        ("d", "5", PIECE, "None"),
        ("e", None, None, "None"),
        ("geometry", "division_id", "geometry", "source_table"),
    ])
    want = [("1", ["a", "b"]), ("2", []), ("3", []), ("4", ["a", "b", "c"])]
    for form in (elections.ballots_by_address, elections.ballots_by_address_union):
        for limit in (0, 1 << 26):
            out = form(base, areas, broadcast_bytes=limit)
            assert rows_of(out.select("uprn", "ballot_ids")) == want


def test_unique_addresses_need_no_grouping(spark):
    base = addresses(spark, [
        ("1", "a", "AA1 1AA", "v", "A", 0.5, 0.5),
        ("2", "a", "AA1 1AA", "v", "A", 5.0, 5.0),
        ("3", "a", "AA1 1AA", "v", "A", None, None),
    ])
    areas = ballots(spark, [
        ("b", "1", PIECE, "Division"), ("a", "2", PIECE, "Organisation"),
        ("b", "3", "POLYGON((0 0,2 0,2 2,0 2,0 0))", "Division"),
    ])
    for limit in (0, 1 << 26):
        out = elections.ballots_by_address(
            base, areas, broadcast_bytes=limit, unique_addresses=True
        )
        assert rows_of(out.select("uprn", "ballot_ids")) == [("1", ["a", "b"]), ("2", []), ("3", [])]


def test_unique_addresses_are_not_shuffled(spark, folder):
    rows = [(str(i), "a", "AA1 1AA", "v", "A", 0.5, 0.5) for i in range(10)]
    addresses(spark, rows).write.parquet(f"{folder}/base")
    base = spark.read.parquet(f"{folder}/base")
    out = elections.ballots_by_address(
        base, ballots(spark, [("b", "1", PIECE, "Division")]), unique_addresses=True
    )
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("BroadcastExchange")[0].split("BroadcastHashJoin")[1]
    assert "SortMergeJoin" not in plan


def test_lists_are_not_shuffled(spark, folder):
    rows = [(str(i), "a", "AA1 1AA", "v", "A", 0.5, 0.5) for i in range(10)]
    addresses(spark, rows).write.parquet(f"{folder}/base")
    areas = ballots(spark, [(f"b{i}", "1", PIECE, "Division") for i in range(100)])
    out = elections.ballots_by_address(spark.read.parquet(f"{folder}/base"), areas)
    assert {len(r["ballot_ids"]) for r in out.collect()} == {100}
    assert "hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()


def test_many_areas_shuffle_no_address(spark):
    out = entry.ballots_many_areas(spark, "/root/testdata/sf0.001")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(uprn" not in plan  # with the lists of its areas, before
    assert "array_join" not in plan  # text is made once per list


def test_only_repeated_addresses_are_merged(spark):
    rows = [(str(i), "a", "AA1 1AA", "v", "A", 0.5 + i % 4, 0.5) for i in range(40)]
    rows += [(str(i), "a", "AA1 1AA", "v", "A", 0.5 + (i + 1) % 4, 0.5) for i in range(0, 40, 8)]
    rows += [("0", None, None, "v", None, 2.5, 0.5)] * 3 + [("3", "a", "AA1 1AA", "v", "A", None, None)]
    areas = ballots(spark, [
        ("c", "1", PIECE, "Division"), ("b", "1", PIECE, "Division"), ("a", "2", "POLYGON((1 0,3 0,3 1,1 1,1 0))", "Division"),
        ("b", "3", "POLYGON((1 0,2 0,2 1,1 1,1 0))", "Organisation"),
    ])
    base = addresses(spark, rows)
    columns = [*elections.ADDRESS_KEYS, "ballot_ids"]
    want = rows_of(elections.ballots_by_address_union(base, areas).select(*columns))
    assert len(want) == 41
    for limit in (0, 1 << 26):
        out = elections.ballots_by_address(base, areas, broadcast_bytes=limit)
        assert rows_of(out.select(*columns)) == want
        out = elections.ballots_by_address(base, areas, broadcast_bytes=limit, shape=lambda ids: F.array_join(ids, "|"))
        assert rows_of(out.select(*columns)) == sorted(((*r[:-1], "|".join(r[-1])) for r in want), key=repr)


def test_no_ballots_at_all(spark):
    base = addresses(spark, [("1", "a", "AA1 1AA", "v", "A", 0.5, 0.5)])
    out = elections.ballots_by_address(base, ballots(spark, []))
    assert rows_of(out.select("uprn", "ballot_ids")) == [("1", [])]
