"""Plan periods: runs of one plan per workspace, their ends and attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.functions.dates import add_months, day_start
from ledgerline.functions.identity import surrogate_id
from ledgerline.operators.hot import SLICE, apart, cut_slices, lookup
from ledgerline.operators.running import Latest, Previous, SumSoFar, running
from ledgerline.plans.events import SUBSCRIPTION, Labels

ATTRIBUTES = [
    "issubscribing",
    "nextresetdate",
    "resetdateofmonth",
    "planresetperiodvalue",
    "remainingresetcount",
    "currenttimes",
    "maxtimes",
]
LEVELS = ["depth1_name", "depth2_name", "depth3_name", "depth4_name", "depth5_name"]
PLAN_COLUMNS = ["title", "grade", "price", "resetperiodvalue", "suppliedresetcount", "planversion"]

# Category type per level column.
LEVEL_OF_TYPE = {
    "planCategoryDepth1": "depth1_name",
    "planCategoryDepth2": "depth2_name",
    "planCategoryDepth3": "depth3_name",
    "planCategoryDepth4": "depth4_name",
    "planCategoryDepth5": "depth5_name",
}


def plan_groups(log: DataFrame, labels: Labels = SUBSCRIPTION, slice_by: str | None = None) -> DataFrame:
    """Number the runs of one plan in each workspace.

    A reset, or a renewal that names no plan, goes on with the plan in force;
    any other event sets it (a stop sets none). A new run starts when an event
    names a plan that was not in force. ``planid`` becomes the plan in force
    after the event, ``group_planid`` the plan of its run, and ``eventid`` the
    last event that named a plan.
    """
    named = F.when(F.col("planid") != "", F.col("planid"))
    rows = log.withColumn("_named", named).withColumn("_first", F.col("idx") == 1)
    is_reset = F.coalesce(F.col("eventname") == labels.reset, F.lit(False))
    is_renewal = F.coalesce(F.col("eventname") == labels.renewed, F.lit(False))
    goes_on = ~F.col("_first") & (is_reset | (is_renewal & F.col("_named").isNull()))
    set_to = F.when(~goes_on, F.struct(F.col("_named").alias("plan")))
    own = F.col("_first") | F.col("_named").isNotNull()
    order = [F.asc("idx")]
    rows = running(
        rows,
        ["workspaceid"],
        order,
        {
            "_now": Latest(set_to),
            "_before": Latest(set_to, strictly=True),
            "_eventid": Latest(F.when(own, F.col("eventid"))),
        },
        slice_by,
    )
    before = F.col("_before.plan")
    starts_run = ~F.col("_first") & ~is_reset & F.coalesce(F.col("_named") != F.coalesce(before, F.lit("")), F.lit(False))
    rows = rows.withColumn("_starts", F.when(starts_run, 1).otherwise(0).cast("bigint"))
    rows = running(rows, ["workspaceid"], order, {"_runs": SumSoFar(F.col("_starts"))}, slice_by)
    of_run = F.when(F.col("_first"), F.col("_named")).when(is_reset, before).otherwise(F.coalesce(F.col("_named"), before))
    return (
        rows.withColumn("group_planid", of_run)
        .withColumn("group_number", F.col("_runs") + 1)
        .withColumn("planid", F.col("_now.plan"))
        .withColumn("sourceid", F.when(own, F.col("eventid")))
        .withColumn("eventid", F.col("_eventid"))
        .drop("_named", "_first", "_now", "_before", "_eventid", "_starts", "_runs")
    )


def period_starts(groups: DataFrame, attributes: Sequence[str] = ()) -> DataFrame:
    """One row per run: its first time, its plan and its last plan-naming event.

    ``attributes`` are taken from that event. Aggregates combine before the
    shuffle, so a run of any length is fine.
    """
    named_at = F.when(F.col("sourceid").isNotNull(), F.col("idx"))
    start = F.min(F.struct("idx", "logtimestamp", "logdatetimestamp"))
    last = F.max_by(F.struct(F.col("sourceid").alias("eventid"), *attributes), named_at)
    runs = groups.groupBy("workspaceid", "group_number").agg(
        start.alias("s"), last.alias("l"), F.max("group_planid").alias("planid")
    )
    return runs.where(F.col("planid").isNotNull()).select(
        "workspaceid",
        F.col("l.eventid").alias("eventid"),
        F.col("s.logtimestamp").alias("logtimestamp_start"),
        F.col("s.logdatetimestamp").alias("logdatetimestamp_start"),
        "planid",
        *[F.col(f"l.{c}").alias(c) for c in attributes],
    )


def with_next_change(starts: DataFrame, groups: DataFrame, hot: Sequence = ()) -> DataFrame:
    """Add ``end_timestamp``: the first event at a later second under another plan.

    Events are folded into one cell per workspace and second, holding the first
    event's time and plan and the time of the first event under a second plan.
    Looking back from the end, each cell knows the next cell and the next cell
    at which the plan changes; one of the two answers for any plan. No pairs of
    events are formed.
    """
    plan = F.coalesce("planid", F.lit("")).alias("plan")
    per_plan = groups.groupBy("workspaceid", F.col("logtimestamp").alias("second"), plan).agg(
        F.min("logdatetimestamp").alias("at")
    )
    w = W.partitionBy("workspaceid", "second").orderBy("at", "plan")
    first = F.first(F.struct("at", "plan")).over(w)
    per_plan = per_plan.withColumn("one", first)
    other = F.when(F.col("plan") != F.col("one.plan"), F.col("at"))
    cells = per_plan.groupBy("workspaceid", "second").agg(F.first("one").alias("one"), F.min(other).alias("other_at"))
    cells = cells.select(
        "workspaceid", "second", F.struct(F.col("one.at").alias("at"), F.col("one.plan").alias("plan"), "other_at").alias("cell")
    )
    cells = apart(
        cells,
        "workspaceid",
        hot,
        lambda part: _look_ahead(part, None),
        lambda part: _look_ahead(cut_slices(part, "workspaceid", [F.asc("second")], "cells-cut"), SLICE).drop(SLICE),
    )

    def answer(cell: Column) -> Column:
        return F.when(cell["plan"] != F.col("planid"), cell["at"]).otherwise(cell["other_at"])

    found = cells.select("workspaceid", F.col("second").alias("logtimestamp_start"), "ahead")
    joined = starts.join(found, ["workspaceid", "logtimestamp_start"], "left")
    end = F.coalesce(answer(F.col("ahead.next")), answer(F.col("ahead.after")))
    return joined.select(*starts.columns, end.alias("end_timestamp"))


def _look_ahead(cells: DataFrame, slice_by: str | None) -> DataFrame:
    """Add ``ahead``: the next cell and the next cell after it at which the plan changes."""
    key, forth, back = ["workspaceid"], [F.asc("second")], [F.desc("second")]
    cells = running(cells, key, forth, {"_prev": Previous(F.col("cell"))}, slice_by)
    same = (
        F.col("cell.other_at").isNull()
        & F.col("_prev.other_at").isNull()
        & F.col("_prev.plan").eqNullSafe(F.col("cell.plan"))
    )
    cells = cells.withColumn("_break", F.when(~same, F.col("cell")))
    cells = running(cells, key, back, {"_next_break": Latest(F.col("_break"), strictly=True)}, slice_by, True)
    ahead = F.struct(F.col("cell").alias("next"), F.col("_next_break").alias("after"))
    return running(cells, key, back, {"ahead": Previous(ahead)}, slice_by, True)


def next_change(starts: DataFrame, groups: DataFrame, hot: Sequence = ()) -> DataFrame:
    """Runs that ended, with the time of the change."""
    ended = with_next_change(starts, groups, hot).where(F.col("end_timestamp").isNotNull())
    return ended.select("eventid", "end_timestamp")


def pivot_levels(rows: DataFrame, key: str, level: str, value: str, columns: dict[str, str]) -> DataFrame:
    """One column per level holding the largest value; one aggregate, no pivot job."""
    picks = [F.max(F.when(F.col(level) == name, F.col(value))).alias(column) for name, column in columns.items()]
    return rows.groupBy(key).agg(*picks)


def category_levels(category: DataFrame, category_value: DataFrame) -> DataFrame:
    names = category_value.select(F.col("id").alias("plancategoryvalueid"), "name")
    return pivot_levels(category.join(names, "plancategoryvalueid", "left"), "planid", "type", "name", LEVEL_OF_TYPE)


def plan_attributes(plan: DataFrame, category: DataFrame, category_value: DataFrame, how: str = "left") -> DataFrame:
    """Plans with their category levels; ``how="inner"`` keeps categorised plans only."""
    levels = category_levels(category, category_value)
    joined = plan.withColumnRenamed("id", "planid").join(levels, "planid", how)
    return joined.select("planid", *PLAN_COLUMNS, *LEVELS)


def one_status(subscription: DataFrame) -> DataFrame:
    """One status per workspace: that of the subscription with the largest id, longer ids last (s9, s10)."""
    return subscription.groupBy("workspaceid").agg(F.max_by("status", F.struct(F.length("id"), "id")).alias("status"))


def subscription_periods(
    groups: DataFrame,
    plans: DataFrame,
    subscription: DataFrame,
    hot: Sequence = (),
) -> DataFrame:
    """Start, end and expected end of each run, with event and plan attributes.

    A run that did not end is expected to last for its remaining resets; for a
    workspace that is no longer active this is also its end.
    """
    starts = with_next_change(period_starts(groups, ATTRIBUTES), groups, hot)
    rows = lookup(starts.join(plans, "planid", "left"), one_status(subscription), "workspaceid", "left", hot)
    months = F.col("remainingresetcount") * F.col("planresetperiodvalue")
    expected = F.when(F.col("end_timestamp").isNull(), add_months(day_start(F.col("nextresetdate")), months))
    inactive = F.col("status") != "ACTIVE"
    end = F.coalesce("end_timestamp", F.when(inactive, expected))
    return rows.select(
        surrogate_id(F.col("workspaceid"), F.col("eventid")).alias("id"),
        "workspaceid",
        "eventid",
        F.col("logdatetimestamp_start").alias("subscription_start"),
        end.alias("subscription_end"),
        expected.alias("expected_subscription_end"),
        "planid",
        *[c for c in ATTRIBUTES if c != "planresetperiodvalue"],
        *PLAN_COLUMNS,
        *LEVELS,
    )


# Attributes of the basic period table.
BASIC = {
    "issubscribing": (True, "boolean"),
    "nextresetdate": (None, "timestamp_ntz"),
    "resetdateofmonth": (1, "int"),
    "remainingresetcount": (1, "int"),
    "currenttimes": (0, "int"),
    "maxtimes": (100, "int"),
    "title": ("Portfolio Plan", "string"),
    "grade": (1, "int"),
    "price": (10000, "bigint"),
    "resetperiodvalue": (1, "int"),
    "suppliedresetcount": (1, "int"),
    "planversion": (1, "int"),
}


def basic_periods(groups: DataFrame) -> DataFrame:
    """One row per event with fixed sample attributes and open ends."""
    return groups.select(
        surrogate_id(F.col("workspaceid"), F.col("eventid"), F.col("idx").cast("string")).alias("id"),
        "workspaceid",
        "eventid",
        F.col("logdatetimestamp").alias("subscription_start"),
        F.lit(None).cast("timestamp_ntz").alias("subscription_end"),
        F.lit(None).cast("timestamp_ntz").alias("expected_subscription_end"),
        "planid",
        *[F.lit(value).cast(kind).alias(name) for name, (value, kind) in BASIC.items()],
        *[F.lit(None).cast("string").alias(name) for name in LEVELS],
    )
