"""Cutting hot keys into slices must not change any result."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgerline.operators import hot
from ledgerline.operators.running import Latest, LatestOfAll, Previous, SumSoFar, TotalOfAll, running, running_measured
from ledgerline.plans import billing, daily, referral
from ledgerline.plans.events import PLAN
from testbed.adapters import AS_OF
from testbed.oracle import BATCH

FEW = 150


def at(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.fixture(scope="module")
def numbers(spark):
    pick = random.Random(7)
    data = [
        (pick.choice("aaaab"), second, i, pick.choice([None, 1, 2, 3]), pick.choice([None, "x", "y"]))
        for i, second in enumerate(pick.choices(range(400), k=600))
    ]
    return spark.createDataFrame(data, "k string, s bigint, i int, n bigint, v string")


@pytest.mark.parametrize("backwards", [False, True])
def test_running_in_slices(numbers, backwards):
    values = {
        "prev": Previous(F.col("v")),
        "last": Latest(F.col("v")),
        "before": Latest(F.col("v"), strictly=True),
        "sofar": SumSoFar(F.col("n")),
        "end": LatestOfAll(F.col("v")),
        "total": TotalOfAll(F.col("n")),
        "top": TotalOfAll(F.col("n"), "max"),
    }
    order = [F.desc("s"), F.desc("i")] if backwards else [F.asc("s"), F.asc("i")]
    whole = running(numbers, ["k"], order, values)
    sliced = numbers.withColumn(hot.SLICE, hot.time_slice("k", F.col("s"), ["a"], grain=25))
    assert sliced.where("k = 'b'").where(F.col(hot.SLICE).isNotNull()).isEmpty()
    parts = running(sliced, ["k"], order, values, hot.SLICE, backwards).drop(hot.SLICE)
    assert rows(parts) == rows(whole)


def test_running_measured(numbers):
    order, values = [F.asc("s"), F.asc("i")], {"prev": Previous(F.col("v")), "sofar": SumSoFar(F.col("n"))}
    whole = running(numbers, ["k"], order, values)
    assert rows(running_measured(numbers, ["k"], F.col("s"), order, values, 200)) == rows(whole)


def test_hot_keys(numbers):
    counts = {r["k"]: r["count"] for r in numbers.groupBy("k").count().collect()}
    assert hot.hot_keys(numbers, "k", counts["b"]) == ["a"]
    assert hot.hot_keys(numbers, "k", counts["a"]) == []


def test_salted_lookup(spark, numbers):
    dim = spark.createDataFrame([("a", 1), ("c", 3)], "k string, w int")
    for how in ("left", "inner", "left_anti"):
        plain = hot.lookup(numbers, dim, "k", how)
        salted = hot.lookup(numbers, dim, "k", how, ["a"], salts=4)
        assert rows(salted) == rows(plain)


def test_event_log(t):
    busy = daily.hot_workspaces(t, FEW)
    assert 0 < len(busy) < t.subscription.count()
    assert rows(daily.event_log(t, hot_rows=FEW)) == rows(daily.event_log(t))


def test_plan_groups(t):
    cut, busy = daily.plan_groups(t, PLAN, FEW)
    whole, none = daily.plan_groups(t, PLAN)
    assert busy and not none
    assert rows(cut) == rows(whole)


def test_subscription_periods(t):
    assert rows(daily.subscription_periods(t, hot_rows=FEW)) == rows(daily.subscription_periods(t))


def test_vouchers(t):
    base, plans = daily.invoice_base(t), daily.plan_attributes(t, "inner")
    busy = hot.hot_keys(base, "workspaceid", 2)
    assert rows(billing.voucher_positions(base, plans, busy)) == rows(billing.voucher_positions(base, plans))


def test_billing(t):
    cut = daily.billing_rawdata(t, at(AS_OF), hot_rows=4)
    assert rows(cut) == rows(daily.billing_rawdata(t, at(AS_OF)))


def test_signing_order_of_one_large_document(t):
    staged = referral.participants_stage(t.document_service, at(BATCH))
    one = staged.withColumn("documentid", F.lit("d"))
    got = sorted(referral.signing_order(one).collect(), key=lambda r: (r.participantid, repr(r.due), repr(r.contact)))
    earliest = min(r.due for r in got if r.due is not None)
    assert [r.ordinal for r in got] == [1 if r.due == earliest else i for i, r in enumerate(got, 1)]


def test_signing_order_restarts_in_each_document(t):
    staged = referral.participants_stage(t.document_service, at(BATCH))
    largest = {}
    for r in referral.signing_order(staged).collect():
        largest.setdefault(r.documentid, []).append(r.ordinal)
    assert all(max(found) <= len(found) and min(found) == 1 for found in largest.values())


def test_a_third_in_one_second_and_a_third_without_a_key(spark):
    """Slices split one second of one key, and rows without a key; the values stay those of plain windows."""
    pick = random.Random(3)
    data = [("a", 7, i, pick.choice([None, 1, 2]), pick.choice([None, "x", "y"])) for i in range(300)]
    data += [(None, pick.randrange(50), i, 1, pick.choice([None, "z"])) for i in range(300)]
    data += [(pick.choice("bcdefgh"), pick.randrange(50), i, 2, "w") for i in range(300)]
    df = spark.createDataFrame(data, "k string, s bigint, i int, n bigint, v string")
    values = {"prev": Previous(F.col("v")), "last": Latest(F.col("v")), "sofar": SumSoFar(F.col("n")), "total": TotalOfAll(F.col("n"))}
    order = [F.asc("s"), F.asc("i")]
    assert set(hot.hot_keys(df, "k")) == {"a", None}
    cut = hot.cut_slices(hot.only(df, "k", ["a", None]), "k", order, "test-cut")
    largest = cut.groupBy("k", hot.SLICE).count().agg(F.max("count")).first()[0]
    assert largest < 300
    whole = running(df, ["k"], order, values)
    assert rows(running_measured(df, ["k"], F.col("s"), order, values)) == rows(whole)


def test_event_log_with_many_events_without_a_workspace(t):
    class Changed:
        def __getattr__(self, name):
            return getattr(t, name)

    changed = Changed()
    log = t.subscription_event_log
    lost = F.pmod(F.xxhash64("id"), F.lit(3)) == 0
    flood = F.pmod(F.xxhash64("id"), F.lit(3)) == 1
    changed.subscription_event_log = log.withColumn(
        "workspaceid", F.when(flood, F.lit("w-flood")).when(~lost, F.col("workspaceid"))
    ).withColumn("logtimestamp", F.when(flood, F.lit(1_600_000_000).cast("bigint")).otherwise(F.col("logtimestamp")))
    assert {None, "w-flood"} <= set(daily.hot_workspaces(changed, FEW))
    assert rows(daily.event_log(changed, hot_rows=FEW)) == rows(daily.event_log(changed, hot_rows=10**9))
