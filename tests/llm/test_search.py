import math

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import queries, search

DATA = "/root/testdata/sf0.001"


def brute(rows, k, asks):
    """All inner products; rows of (id, vector), repeated rows and repeated queries as they come."""
    out = []
    for q, v in rows:
        if asks(q):
            scored = [(-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in rows if i != q]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def answers(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_brute_force(spark, sf):
    data = f"/root/testdata/{sf}"
    rows = [
        (r.vec_id, [math.floor(256 * float(x)) for x in r.embedding])
        for r in spark.read.parquet(f"{data}/embeddings.parquet").collect()
    ]
    assert answers(queries.QUERIES["op2_pivot_search"](spark, data)) == brute(rows, 5, lambda i: i % 50 == 0)


def test_many_parts_ties_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(search, "CHUNK", 16)
    monkeypatch.setattr(search, "QUERIES", 4)
    monkeypatch.setattr(search, "FIRST", 1)
    rows = [(i, [(i * 7919) % 13 - 6, (i * 104729) % 11 - 5, i % 3]) for i in range(400)]
    rows += [(1000 + i, [3, 3, 3]) for i in range(150)] + [(50, [1, 2, 3]), (50, [1, 2, 3]), (7, [])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>").repartition(5)
    df = df.withColumn("cell", F.lit("x")).withColumn("score", F.lit(1)).withColumn("row", F.lit(2))
    got = answers(search.top_k(df, F.col("vec_id") % 50 == 0, k=4))
    padded = [(i, v or [0, 0, 0]) for i, v in rows]
    assert got == brute(padded, 4, lambda i: i % 50 == 0)


def test_unusable_vectors_take_no_part(spark):
    rows = [
        (0, [1.0, 0.5]),
        (1, [0.5, -0.001]),
        (2, None),
        (3, [float("nan"), 1.0]),
        (4, [float("inf"), 1.0]),
        (5, [None, 1.0]),
        (None, [1.0, 1.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    kept = df.filter(search.usable(F.col("embedding"))).select("vec_id", search.scaled(F.col("embedding")).alias("vector"))
    assert answers(search.top_k(kept, F.col("vec_id") % 50 == 0)) == [(0, 1, 1, 256 * 128 + 128 * -1)]
    assert search.top_k(kept.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_large_numbers_stay_exact(spark):
    rows = [(0, [2**28 + 1, 1]), (1, [2**28 - 1, 3]), (2, [2**28 - 1, 2])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    assert answers(search.top_k(df, F.col("vec_id") == 0)) == brute(rows, 5, lambda i: i == 0)
