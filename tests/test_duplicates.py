import pytest
from pyspark.errors import AnalysisException

from doorstep.operators.duplicates import (
    ConflictingDuplicates,
    IdenticalDuplicates,
    duplicate_keys,
    duplicated_rows,
    has_unique_keys,
    resolve_duplicates,
)

from conftest import rows_of

SCHEMA = "uprn string, postcode string, addressbase_source string"
ONE = ("1", "AA1 1AA", "v1")
ONE_OTHER = ("1", "AA1 1AA", "v2")
TWO = ("2", "AA1 1BB", "v1")
TWO_OTHER = ("2", "AA1 1BB", "v2")
THREE = ("3", "SW1A 3AA", "v1")


def resolve(spark, rows, **options):
    return resolve_duplicates(spark.createDataFrame(rows, SCHEMA), **options)


def test_missing_uprn_column(spark):
    df = spark.createDataFrame([("AA1 1AA", "v1")], "postcode string, s string")
    with pytest.raises(AnalysisException):
        resolve_duplicates(df)


def test_no_duplicates_unchanged(spark):
    df = spark.createDataFrame([ONE, TWO], SCHEMA)
    assert resolve_duplicates(df) is df


@pytest.mark.parametrize(
    "rows, n",
    [([ONE, ONE, TWO], 2), ([ONE, ONE, TWO, TWO, THREE], 3), ([ONE], 1), ([], 0)],
)
def test_identical_copies_are_dropped(spark, rows, n):
    found = rows_of(resolve(spark, rows))
    assert found == sorted(set(rows), key=repr) and len(found) == n


def test_identical_copies_are_reported_once(spark):
    reports = []
    resolve(spark, [ONE, ONE, ONE], on_identical=reports.append).collect()
    assert len(reports) == 1 and isinstance(reports[0], IdenticalDuplicates)
    assert str(reports[0]).startswith("1 UPRN has duplicated rows for first_letter=A")


def test_conflict_raises_with_message(spark):
    with pytest.raises(ConflictingDuplicates) as error:
        resolve(spark, [ONE, ONE_OTHER])
    assert str(error.value).startswith("1 UPRN has duplicated rows for first_letter=A")


def test_message_counts_all_repeated_keys_of_the_letter(spark):
    with pytest.raises(ConflictingDuplicates, match="2 UPRNs have duplicate rows for first_letter=A"):
        resolve(spark, [ONE, ONE, TWO, TWO_OTHER])


def test_conflict_in_one_letter_only_names_it(spark):
    with pytest.raises(ConflictingDuplicates) as error:
        resolve(spark, [ONE, ONE_OTHER, THREE, THREE])
    assert "first_letter=A" in str(error.value)
    assert "first_letter=S" not in str(error.value)


def test_missing_uprn_value_counts_as_a_key(spark):
    rows = [(None, "AA1 1AA", "v1"), (None, "AA1 1AA", "v1"), ONE]
    assert len(rows_of(resolve(spark, rows))) == 2
    with pytest.raises(ConflictingDuplicates):
        resolve(spark, [(None, "AA1 1AA", "v1"), (None, "AA1 1AA", "v2")])


def test_lists_in_rows(spark):
    schema = "uprn string, postcode string, ballot_ids array<string>"
    same = [("1", "AA1 1AA", ["x", "y"])] * 2
    assert resolve_duplicates(spark.createDataFrame(same, schema)).count() == 1
    differ = [("1", "AA1 1AA", ["x", "y"]), ("1", "AA1 1AA", ["x"])]
    with pytest.raises(ConflictingDuplicates):
        resolve_duplicates(spark.createDataFrame(differ, schema))


def test_report(spark):
    df = spark.createDataFrame(
        [ONE, ONE_OTHER, TWO, THREE, THREE, (None, "A1", "v1"), (None, "A2", "v1")], SCHEMA
    )
    assert rows_of(duplicate_keys(df)) == [("1", 2), ("3", 2), (None, 2)]
    listed = [r["uprn"] for r in duplicated_rows(df).collect()]
    assert listed == [None, None, "1", "1", "3", "3"]
    assert not has_unique_keys(df)
    assert has_unique_keys(spark.createDataFrame([ONE, TWO], SCHEMA))


def test_empty_key_is_not_a_missing_key(spark):
    df = spark.createDataFrame([("", "A1", "v"), (None, "A1", "v")], SCHEMA)
    assert duplicated_rows(df).count() == 0


def test_only_rows_of_repeated_keys_are_gathered(spark):
    """The others come back as they are, whatever columns they have, and once."""
    rows = [(str(i), "A1 1AA", "v1") for i in range(50)] + [("7", "A1 1AA", "v1"), (None, "A1 1AA", "v1"), (None, "A1 1AA", "v1")]
    df = spark.createDataFrame(rows, "uprn string, postcode string, addressbase_source string")
    errors = []
    found = resolve_duplicates(df, on_identical=errors.append)
    assert rows_of(found) == sorted(set(rows), key=repr)
    assert len(errors) == 1 and str(errors[0]).startswith("2 UPRNs have duplicate rows for first_letter=A")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # stored: readers do not resolve again
