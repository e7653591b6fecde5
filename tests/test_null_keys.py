"""NULL keys never match, as in SQL; amounts keep their scale; staging needs a folder."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.intervals import interval_join
from ledgerline.operators.ordering import cut, positions
from ledgerline.plans import billing, events, periods
from ledgerline.sources import tables


def day(n):
    return dt.datetime(2024, 1, n)


def test_interval_join_ignores_null_keys(spark):
    facts = spark.createDataFrame(
        [("a", day(2)), (None, day(2)), ("a", day(9)), ("a", day(4))], "k string, at timestamp_ntz"
    )
    intervals = spark.createDataFrame(
        [("a", day(1), day(5), "p"), (None, day(1), day(5), "q"), ("a", day(3), day(4), "r")],
        "k string, s timestamp_ntz, e timestamp_ntz, plan string",
    )
    got = interval_join(facts, intervals, "k", "at", "s", "e", ["plan"]).collect()
    want = [("a", day(2), "p"), ("a", day(4), "p"), ("a", day(9), None), (None, day(2), None)]
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)


def log(spark, workspace):
    rows = [
        ("e1", workspace, 1, "SUBSCRIPTION_STARTED", "P1"),
        ("e2", workspace, 2, "SUBSCRIPTION_CHANGED", "P1"),
        ("e3", workspace, 3, events.MIGRATIONS[0], "M1"),
        ("e4", workspace, 4, events.SUBSCRIPTION.reset, "P2"),
    ]
    df = spark.createDataFrame(rows, "eventid string, workspaceid string, logtimestamp long, eventname string, planid string")
    return df.withColumn("logmicrosecondstamp", F.col("logtimestamp")).withColumn("nextplanid", F.lit(None).cast("string"))


@pytest.mark.parametrize(("workspace", "plans"), [("w", ["M1", "M1", "M1", "P2"]), (None, ["P1", "P1", "M1", "P2"])])
def test_remap_migrated_ignores_null_workspaces(spark, workspace, plans):
    found = events.remap_migrated(events.index_events(log(spark, workspace))).orderBy("eventid").collect()
    assert [r.planid for r in found] == plans


@pytest.mark.parametrize(("workspace", "plans"), [("w", ["P1", "P1", "P2", "P2"]), (None, ["P1", "P1", "M1", "P2"])])
def test_remap_reset_ignores_null_workspaces(spark, workspace, plans):
    found = events.remap_reset(events.index_events(log(spark, workspace))).orderBy("eventid").collect()
    assert [r.planid for r in found] == plans


def test_amounts_keep_their_scale(spark):
    base = spark.createDataFrame(
        [("i", "p", "PLAN", "PAID", "R", "w", Decimal("10.12345678"), Decimal("10.12545678"), day(2), "it", "T", "P1")],
        "id string, paymentid string, purchaseitemcategory string, status string, invoicetype string, workspaceid string, "
        "amount decimal(19,8), finalamount decimal(19,8), createdat timestamp_ntz, purchaseitemid string, title string, planid string",
    )
    for name in ("type", "featureusageaction", "pluginaction"):
        base = base.withColumn(name, F.lit(None).cast("string"))
    for name in ("periodstart", "periodend", "invoicecreatedat", "refundedat"):
        base = base.withColumn(name, F.lit(None).cast("timestamp_ntz"))
    base = base.withColumn("refundedamount", F.lit(None).cast("decimal(19,8)"))
    plans = spark.createDataFrame([], "planid string, depth1_name string, depth5_name string, suppliedresetcount int")
    runs = spark.createDataFrame(
        [], "workspaceid string, planid string, subscription_start timestamp_ntz, subscription_end timestamp_ntz"
    )
    row = billing.invoice_adjusted(base, plans, runs, F.lit(day(5)).cast("timestamp_ntz")).first()
    assert row.adj_finalamount == row.finalamount_diff == Decimal("10.12545678")


def test_stage_without_a_folder_fails(spark, monkeypatch):
    monkeypatch.setattr(tables, "stage_dir", lambda session, real=tables.stage_dir: real(NoFolder()))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        tables.stage(spark.range(3), "x")


class NoFolder:
    class conf:  # noqa: N801
        @staticmethod
        def get(name, default=None):
            return default


def test_positions_over_hot_and_null_keys(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.when(F.col("id") % 2 == 0, F.col("id"))).alias("k"),
        F.monotonically_increasing_id().alias("tie"),
        (F.col("id") % 5).alias("size"),
    )
    order = ["k", "tie"]
    got = positions(cut(rows, order, "test-cut"), order, F.col("size")).collect()
    got.sort(key=lambda r: r._row)
    assert [r._row for r in got] == list(range(3000))
    keys = [(r.k is not None, r.k or 0, r.tie) for r in got]
    assert keys == sorted(keys)
    total = 0
    for r in got:
        assert r._before == total
        total += r["size"]
    assert positions(cut(rows.limit(0), order, "test-cut"), order).count() == 0


def test_the_later_of_two_subscriptions_counts(spark):
    df = spark.createDataFrame([("s9", "w", "OLD"), ("s10", "w", "NEW")], "id string, workspaceid string, status string")
    assert [r.status for r in periods.one_status(df).collect()] == ["NEW"]
