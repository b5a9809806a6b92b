import os

import duckdb
import pytest

import __spark_entry__ as entry
from doorstep import fixtures as fx

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in fx.TABLES:
        if os.path.exists(f"{SF}/{name}.parquet"):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_comparison_sql():
    assert set(entry.layer_queries()) == set(entry.layer_sql())


@pytest.mark.parametrize("name", sorted(entry.layer_queries()))
def test_query_equals_sql(spark, database, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    cursor = database.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=repr)
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
