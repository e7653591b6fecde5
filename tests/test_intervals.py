"""Overlapping intervals: buckets of time, heavy buckets, repeats."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgerline.functions.dates import epoch_micros
from ledgerline.operators import intervals
from ledgerline.operators.intervals import interval_join

DAY = datetime(2024, 1, 1)
FACT = "i int, k string, t timestamp_ntz, use boolean"
SPAN = "k string, a timestamp_ntz, b timestamp_ntz, name string"


def expected(facts, spans):
    found = []
    for i, k, t, use in facts:
        hits = [n for kk, a, b, n in spans if use and None not in (k, t, kk, a) and kk == k and a <= t < b]
        found += [(i, n) for n in hits or [None]]
    return sorted(found, key=repr)


def joined(spark, facts, spans, hot=()):
    fact, span = spark.createDataFrame(facts, FACT), spark.createDataFrame(spans, SPAN)
    return rows(interval_join(fact, span, "k", "t", "a", "b", ["name"], F.col("use"), hot).select("i", "name"))


@pytest.mark.parametrize("hot", [[], ["k0"]])
@pytest.mark.parametrize("scale", [1, 3_600_000_000, 10**13])
def test_overlaps_at_every_scale(spark, scale, hot):
    """From single microseconds to centuries before and after 1970."""
    pick = random.Random(scale)
    when = lambda: datetime(1970, 1, 1) + timedelta(microseconds=pick.randint(-150, 150) * scale + pick.randint(0, 1))
    spans = []
    for n in range(60):
        a, b = sorted([when(), when()])
        spans.append((f"k{n % 2}", a, b, f"n{n}"))
    spans += spans[:5]
    facts = [(i, pick.choice(["k0", "k1", "k2", None]), when(), pick.random() < 0.9) for i in range(150)]
    facts += [(150, "k0", None, True), (151, "k0", spans[0][1], True), (152, "k0", spans[0][2], True), (153, "k0", spans[0][1], None)]
    assert joined(spark, facts, spans, hot) == expected(facts, spans)


@pytest.mark.parametrize("hot", [[], ["k0"]])
def test_several_carried_columns(spark, hot):
    """Overhangs that carry their ends, too, reach the end of the plan whole."""
    pick = random.Random(5)
    spans = []
    for n in range(40):
        a, b = sorted(DAY + timedelta(hours=pick.randint(0, 200)) for _ in range(2))
        spans.append((f"k{n % 2}", a, b, f"n{n}"))
    facts = [(i, f"k{i % 2}", DAY + timedelta(hours=pick.randint(0, 200)), True) for i in range(60)]
    fact, span = spark.createDataFrame(facts, FACT), spark.createDataFrame(spans, SPAN)
    found = interval_join(fact, span, "k", "t", "a", "b", ["name", "a", "b"], F.col("use"), hot)
    got = sorted(((r.i, r.name, r.a, r.b) for r in found.select("i", F.col("name"), "a", "b").collect()), key=repr)
    wanted = []
    for i, k, t, _ in facts:
        wanted += [(i, n, a, b) for kk, a, b, n in spans if kk == k and a <= t < b] or [(i, None, None, None)]
    assert got == sorted(wanted, key=repr)


def test_no_overlap_needs_no_buckets(spark, monkeypatch):
    monkeypatch.setattr(intervals, "_stabbed", None)
    spans = [("k", DAY + timedelta(hours=n), DAY + timedelta(hours=n + 1), f"n{n}") for n in range(5)]
    facts = [(i, "k", DAY + timedelta(minutes=13 * i), True) for i in range(30)]
    assert joined(spark, facts, spans) == expected(facts, spans)


@pytest.mark.parametrize("facts, spans", [([], []), ([(1, "k", DAY, True)], []), ([], [("k", DAY, DAY, "n")])])
def test_empty_tables(spark, facts, spans):
    assert joined(spark, facts, spans) == expected(facts, spans)


def test_heavy_bucket_is_dealt_over_groups(spark, monkeypatch):
    """One key, all intervals around all facts: no group holds more than a block's pairs or so."""
    monkeypatch.setattr(intervals, "BLOCK", 8)
    spans = [("k", DAY, DAY + timedelta(days=64), f"n{n}") for n in range(64)]
    facts = [(i, "k", DAY + timedelta(days=20, microseconds=i), True) for i in range(64)]
    assert joined(spark, facts, spans) == expected(facts, spans)

    fact = spark.createDataFrame(facts, FACT).withColumn("_id", F.monotonically_increasing_id())
    over = spark.createDataFrame(spans, SPAN).select(
        "k", F.col("a").alias("_next"), F.struct(F.col("b").alias("end"), "name").alias("_over"), F.monotonically_increasing_id().alias("_id")
    )
    pairs = intervals._stabbed(fact, over, "k", "t")
    assert pairs.count() == 64 * 64
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    last = next(line for line in plan.splitlines() if "Join Inner" in line)
    assert "_line" in last and "_column" in last


def test_epoch_micros(spark):
    at = [datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(2024, 2, 29, 1, 2, 3, 45), datetime(1, 1, 1)]
    found = spark.createDataFrame([(t,) for t in at], "t timestamp_ntz").select(epoch_micros(F.col("t"))).collect()
    assert [r[0] for r in found] == [(t - datetime(1970, 1, 1)) // timedelta(microseconds=1) for t in at]
