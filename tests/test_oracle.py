"""Each registered query gives the rows of its SQL check."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import DATA
from testbed.adapters import RAW
from testbed.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in RAW:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(entry.oracle_sql())))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    expected = [dict(zip(columns, row)) for row in cursor.fetchall()]
    assert sorted(df.columns) == sorted(columns)
    names = sorted(columns)
    got = sorted(repr(tuple(row[n] for n in names)) for row in df.collect())
    assert got == sorted(repr(tuple(row[n] for n in names)) for row in expected)


def test_every_query_has_a_check():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert "subscription_start" in entry.entry(spark).columns
