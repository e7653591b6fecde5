import duckdb
import pytest

import __spark_entry__ as entry
from conftest import DATA
from ledgerline.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    df = entry.queries()[name](spark, DATA)
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    order = [columns.index(c) for c in df.columns]
    want = sorted(tuple(row[i] for i in order) for row in cursor.fetchall())
    assert sorted((tuple(r) for r in df.collect()), key=repr) == sorted(want, key=repr)


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert {f"op{n}_" for n in range(1, 14)} == {name.split("_")[0] + "_" for name in QUERIES}
