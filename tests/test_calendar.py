"""The calendar columns against a plain loop, and the plan that they take."""

import datetime

from conftest import rows
from ledgerline.plans import billing

SCHEMA = (
    "workspaceid string, invoiceid string, status string, paymentid string, finalamount decimal(19,8), "
    "subscription_start timestamp_ntz, datevalue timestamp_ntz, subscription_initial_start_point boolean"
)


def ledger(spark, n=300):
    made = []
    for i in range(n):
        day = None if i % 23 == 0 else datetime.datetime(2020 + i * 7 % 3, 1 + i * 5 % 12, 1 + i % 28)
        space = None if i % 5 == 0 else f"w{i % 4}"
        made.append((space, f"i{i:04d}", "PAID", f"p{i}", None, day, day, None if i % 11 == 0 else i % 7 == 0))
    return spark.createDataFrame(made, SCHEMA)


def keys(day):
    if day is None:
        return {unit: None for unit in billing.CALENDAR}
    quarter = (day.month - 1) // 3
    return {"year": day.year, "quarter": (day.year, quarter), "month": (day.year, day.month)}


def test_calendar_against_a_loop(spark):
    table = ledger(spark)
    found = {r.invoiceid: r for r in billing.billing_calendar(table).collect()}
    stored = table.collect()
    assert len(found) == len(stored)
    for row in stored:
        same = [r for r in stored if r.workspaceid == row.workspaceid]
        ordered = sorted(same, key=lambda r: (r.datevalue is None, r.datevalue or datetime.datetime.max, r.invoiceid))
        at = ordered.index(row)
        got = found[row.invoiceid]
        assert got.prev_datevalue == (ordered[at - 1].datevalue if at else None)
        for unit in billing.CALENDAR:
            peers = [r for r in same if keys(r.datevalue)[unit] == keys(row.datevalue)[unit]]
            marks = [r.subscription_initial_start_point for r in peers if r.subscription_initial_start_point is not None]
            assert got[f"new_yn_{unit}"] == (max(marks) if marks else None)
            assert abs(got[f"workspace_all_count_{unit}"] - 1 / len(peers)) < 1e-12


def test_hot_workspaces_give_the_same(spark):
    table = ledger(spark)
    assert rows(billing.billing_calendar(table, ["w1", billing.NO_WORKSPACE])) == rows(billing.billing_calendar(table))


def test_one_sort_and_one_shuffle(spark):
    table = ledger(spark).repartition(3)
    plan = billing.billing_calendar(table)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(_ws") == 1
    assert plan.count("Sort [") == 1
