import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgerline.operators.intervals import interval_join
from ledgerline.operators.matching import first_per, nearby_history, not_in, sole_rows
from ledgerline.sources.tables import delete_matching, delete_where

DAY = datetime(2024, 1, 1)


def ints(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "k int")


@pytest.mark.parametrize(
    "listed, expected", [((1, None), []), ((1,), [2]), ((), [1, 2, None]), ((None,), []), ((3,), [1, 2])]
)
def test_not_in(spark, listed, expected):
    found = not_in(ints(spark, 1, 2, None), "k", ints(spark, *listed))
    assert sorted([r["k"] for r in found.collect()], key=str) == sorted(expected, key=str)


def test_sole_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    assert rows(sole_rows(df, "k")) == rows(df.where("v IN ('c', 'd')"))
    two = df.union(spark.createDataFrame([(None, "e")], df.schema))
    assert rows(sole_rows(two, "k")) == [(2, "c")]


def test_first_per(spark):
    df = spark.createDataFrame([("x", None), ("x", 2), ("x", 1), ("y", None)], "k string, v int")
    assert rows(first_per(df, ["k"], [F.asc_nulls_last("v")])) == [("x", 1), ("y", None)]


def history_match(spark, *offsets):
    ledger = spark.createDataFrame([("p", "PAID", DAY)], "paymentid string, status string, datevalue timestamp_ntz")
    data = [(f"h{i}", "p", "PAID", DAY + timedelta(seconds=s)) for i, s in enumerate(offsets)]
    history = spark.createDataFrame(data, "id string, paymentid string, paymentstatus string, timestamp timestamp_ntz")
    return sorted(str(r["paymenthistoryid"]) for r in nearby_history(ledger, history).collect())


@pytest.mark.parametrize("offset, hit", [(0, True), (5, True), (6, True), (59, True), (119, True), (120, False), (-5, True)])
def test_history_with_one_row(spark, offset, hit):
    assert history_match(spark, offset) == (["h0"] if hit else ["None"])


def test_history_with_several_rows(spark):
    assert history_match(spark, 6, 300) == ["None"]
    assert history_match(spark, 5, -5, 6, -6, 0.9) == ["h0", "h1", "h4"]


def test_delete_where_keeps_unknown(spark):
    assert rows(delete_where(ints(spark, 1, 2, None), F.col("k") == 1)) == [(2,), (None,)]


def test_delete_matching_against_all_pairs(spark):
    pick = random.Random(1)
    make = lambda n: [(pick.choice("abcd"), pick.choice([None, "p", "q", "r"])) for _ in range(n)]
    stored, staged = make(40), make(6)
    schema = "d string, p string"
    found = delete_matching(spark.createDataFrame(stored, schema), spark.createDataFrame(staged, schema), ["d"], "p")
    differs = lambda a, b: a[0] == b[0] and None not in (a[1], b[1]) and a[1] != b[1]
    expected = [s for s in stored if not any(differs(s, g) for g in staged)]
    assert rows(found) == sorted(expected, key=repr)


@pytest.mark.parametrize("overlapping", [False, True])
@pytest.mark.parametrize("hot", [[], ["k1"]])
def test_interval_join_against_all_pairs(spark, overlapping, hot):
    pick = random.Random(11)
    when = lambda s: DAY + timedelta(seconds=s)
    spans = []
    for k in ("k1", "k2", "k3"):
        start = 0
        for n in range(8):
            start = pick.randint(0, 900) if overlapping else start + pick.randint(0, 60)
            end = start + pick.randint(0, 200 if overlapping else 60)
            spans.append((k, when(start), when(end), f"{k}-{n}"))
            start = end
    facts = [(i, pick.choice(["k1", "k2", "k3", "k4"]), when(pick.randint(0, 1000)), pick.random() < 0.8) for i in range(200)]
    fact = spark.createDataFrame(facts, "i int, k string, t timestamp_ntz, use boolean")
    span = spark.createDataFrame(spans, "k string, a timestamp_ntz, b timestamp_ntz, name string")
    found = interval_join(fact, span, "k", "t", "a", "b", ["name"], F.col("use"), hot).select("i", "name")
    expected = []
    for i, k, t, use in facts:
        hits = [name for kk, a, b, name in spans if use and kk == k and a <= t < b]
        expected += [(i, name) for name in hits or [None]]
    assert rows(found) == sorted(expected, key=repr)
