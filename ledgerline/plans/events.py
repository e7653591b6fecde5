"""One clean, ordered event log per workspace out of three raw logs.

Every step after ``gather`` works on rows that sit together by workspace, so the
whole chain needs one shuffle of the log. ``slice_by`` names the slice column of
hot workspaces (``operators.hot``); it is None when there are none.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.functions.dates import epoch_seconds, next_reset_date
from ledgerline.operators.hot import SLICE, count_rows, cut_slices, heaviest
from ledgerline.operators.running import Latest, LatestOfAll, Previous, SumSoFar, TotalOfAll, running


@dataclass(frozen=True)
class Labels:
    """Names the log uses for a renewal and for a reset."""

    renewed: str
    reset: str


# Event names of the logs.
PLAN = Labels("PLAN_RENEWED", "PLAN_RESET")
SUBSCRIPTION = Labels("SUBSCRIPTION_RENEWED", "SUBSCRIPTION_RESET")
APPLIED = "APPLIED_PLAN_RENEWED"
TERMINATED = "SUBSCRIPTION_TERMINATED"
STOPPED = "SUBSCRIPTION_STOPPED"
CHANGED = "SUBSCRIPTION_CHANGED"
NEXT_PLAN_CHANGED = "SUBSCRIPTION_NEXT_PLAN_CHANGED"
SNAPSHOT = "SNAPSHOT"
MIGRATIONS = ("PLAN_MIGRATION_2022_01", "PLAN_MIGRATION_2022_03", "PLAN_MIGRATION_2022_11")
RESETS_PER_INTERVAL = {"MONTH": 1, "YEAR": 12}

COLUMNS = [
    "eventid",
    "workspaceid",
    "logdatetimestamp",
    "logtimestamp",
    "logmicrosecondstamp",
    "eventname",
    "planid",
    "nextplanid",
    "issubscribing",
    "nextresetdate",
    "resetdateofmonth",
    "planresetperiodvalue",
    "plansuppliedresetcount",
    "remainingresetcount",
    "currenttimes",
    "maxtimes",
]
TYPES = {
    "nextplanid": "string",
    "issubscribing": "boolean",
    "nextresetdate": "timestamp_ntz",
    "resetdateofmonth": "int",
    "planresetperiodvalue": "int",
    "plansuppliedresetcount": "int",
    "remainingresetcount": "int",
    "currenttimes": "int",
    "maxtimes": "int",
}

# Ties within a second and microsecond are broken by id.
ORDER = ("logtimestamp", "logmicrosecondstamp", "eventid")


def _asc() -> list[Column]:
    return [F.asc_nulls_last(c) for c in ORDER]


def from_v1(log: DataFrame) -> DataFrame:
    return log.withColumnRenamed("id", "eventid").select(
        *[F.col(c).cast(TYPES[c]).alias(c) if c in TYPES else F.col(c) for c in COLUMNS]
    )


def from_custom(log: DataFrame) -> DataFrame:
    """Hand-made events: never subscribing, and no reset attributes."""
    own = {"eventid": F.col("id"), "logmicrosecondstamp": F.col("logtimestamp"), "issubscribing": F.lit(False)}
    stored = {"workspaceid", "logdatetimestamp", "logtimestamp", "eventname", "planid"}
    return log.select(
        *[
            (own[c] if c in own else F.col(c) if c in stored else F.lit(None).cast(TYPES[c])).alias(c)
            for c in COLUMNS
        ]
    )


def relabel_v2(
    log: DataFrame, subscription: DataFrame, labels: Labels = SUBSCRIPTION, hot: Sequence = ()
) -> DataFrame:
    """The second log with the first one's event names, before duplicate removal.

    A renewal whose count did not fall is a plan change when the plan differs
    from the previous event's, else a renewal; a yearly one that started over
    is a reset. With hot workspaces the result carries their slice column.
    """
    owner = subscription.select(F.col("id").alias("subscriptionid"), "workspaceid")
    rows = log.join(owner, "subscriptionid").withColumnRenamed("id", "eventid")
    rows = rows.withColumn("logtimestamp", epoch_seconds(F.col("logdatetimestamp")))
    if hot:
        # Events of one second and microsecond stay in one slice, so that redelivered ones meet.
        rows = cut_slices(rows, "workspaceid", _asc()[:2], "relabel-cut")
    rows = running(
        rows,
        ["workspaceid"],
        _asc(),
        {"_count": Previous(F.col("renewalcount")), "_plan": Previous(F.col("appliedplanplanid"))},
        SLICE if hot else None,
    )
    renewal = F.col("eventname").eqNullSafe(APPLIED)
    went_on = F.col("_count") <= F.col("renewalcount")
    other_plan = F.col("_plan") != F.col("appliedplanplanid")
    started_over = (F.col("subscribingplanplaninterval") == "YEAR") & (F.col("renewalcount") >= 0)
    renewal_name = (
        F.when(went_on & other_plan, CHANGED)
        .when(went_on, labels.renewed)
        .when(started_over, labels.reset)
        .otherwise(labels.renewed)
    )
    terminated = F.col("eventname").eqNullSafe(TERMINATED)
    interval = F.col("subscribingplanplaninterval")
    resets = F.coalesce(*[F.when(interval == name, n) for name, n in RESETS_PER_INTERVAL.items()])
    derived = {
        "eventname": F.when(renewal, renewal_name).when(terminated, STOPPED).otherwise(F.col("eventname")),
        "planid": F.when(~terminated, F.col("appliedplanplanid")),
        "nextplanid": F.lit(None).cast("string"),
        "issubscribing": F.col("maxtimes") == -1,
        "nextresetdate": next_reset_date(F.col("logdatetimestamp"), F.col("renewaldateofmonth")),
        "resetdateofmonth": F.col("renewaldateofmonth"),
        "planresetperiodvalue": F.lit(1),
        "plansuppliedresetcount": resets,
        "remainingresetcount": F.col("renewalcount"),
    }
    return rows.select(*[(derived.get(c, F.col(c))).alias(c) for c in COLUMNS], *([SLICE] if hot else []))


def drop_redelivered(events: DataFrame) -> DataFrame:
    """One event per workspace, second and microsecond: the smallest id."""
    slices = [SLICE] if SLICE in events.columns else []
    same = W.partitionBy("workspaceid", *slices, "logtimestamp", "logmicrosecondstamp").orderBy(F.asc_nulls_last("eventid"))
    return events.withColumn("_n", F.row_number().over(same)).where("_n = 1").drop("_n")


def hot_workspaces(
    v1: DataFrame, v2: DataFrame, custom: DataFrame, subscription: DataFrame, rows: int | None = None
) -> list:
    """Workspaces whose raw events, over all logs, exceed what one task should sort."""
    by_subscription = count_rows(v2, "subscriptionid").join(
        subscription.select(F.col("id").alias("key"), "workspaceid"), "key"
    )
    counts = (
        count_rows(v1, "workspaceid")
        .union(count_rows(custom, "workspaceid"))
        .union(by_subscription.select("workspaceid", "n"))
    )
    return heaviest(counts, rows)


def index_events(events: DataFrame, slice_by: str | None = None) -> DataFrame:
    """Position from the front and from the back, and the plan announced just before."""
    one = F.lit(1).cast("bigint")
    rows = running(
        events,
        ["workspaceid"],
        _asc(),
        {
            "prev_nextplanid": Previous(F.col("nextplanid")),
            "_lastplanid": Previous(F.col("planid")),
            "idx": SumSoFar(one),
            "_all": TotalOfAll(one),
        },
        slice_by,
    )
    return rows.withColumn("idx_inverse", F.col("_all") - F.col("idx") + 1).drop("_all")


def remap_migrated(events: DataFrame, slice_by: str | None = None) -> DataFrame:
    """Replace an old plan by the plan of the nearest later migration away from it.

    A migration event is also entered under the plan it ended. Going back in
    time over (workspace, plan), each event then sees the first migration at a
    later second. ``mapped_planid`` is NULL where there is none.
    """
    ends_plan = F.col("eventname").isin(*MIGRATIONS) & F.col("_lastplanid").isNotNull()
    target = F.struct(F.col("planid").alias("to"))
    itself = F.struct(F.col("planid").alias("plan"), F.lit(0).alias("kind"), F.lit(None).cast("struct<to:string>").alias("new"))
    ended = F.struct(F.col("_lastplanid").alias("plan"), F.lit(1).alias("kind"), target.alias("new"))
    probes = events.withColumn("_p", F.explode(F.when(ends_plan, F.array(itself, ended)).otherwise(F.array(itself))))
    probes = probes.withColumn("_plan", F.col("_p.plan"))
    backwards = [
        F.desc("logtimestamp"),
        F.asc("_p.kind"),
        F.desc("logmicrosecondstamp"),
        F.desc("eventid"),
    ]
    found = running(probes, ["workspaceid", "_plan"], backwards, {"_new": Latest(F.col("_p.new"))}, slice_by, True)
    # rows without a workspace lie in one window, but belong to no migration
    mapped = F.when(F.col("workspaceid").isNotNull(), F.col("_new.to"))
    found = found.where("_p.kind = 0").withColumn("mapped_planid", mapped)
    return found.withColumn("planid", F.coalesce("mapped_planid", "planid")).drop("_p", "_plan", "_new", "_lastplanid")


def relabel_events(events: DataFrame, labels: Labels = SUBSCRIPTION) -> DataFrame:
    """Migrations become snapshots; announced and carried-out plan changes are told apart.

    The announced plan is compared with the event's own plan, before remapping.
    """
    carried_out = (F.col("eventname") == labels.reset) & (F.col("prev_nextplanid") == F.col("planid"))
    announced = (F.col("eventname") == CHANGED) & F.col("nextplanid").isNotNull()
    name = (
        F.when(F.col("eventname").isin(*MIGRATIONS), SNAPSHOT)
        .when(announced, NEXT_PLAN_CHANGED)
        .when(carried_out, CHANGED)
        .otherwise(F.col("eventname"))
    )
    return events.withColumn("_named", name)


def remap_reset(
    events: DataFrame,
    labels: Labels = SUBSCRIPTION,
    keep_plan_of: Sequence[str] = (),
    slice_by: str | None = None,
) -> DataFrame:
    """Where a reset moved a workspace to another plan, use that plan throughout.

    For each (workspace, former plan) the latest such reset counts. Events named
    in ``keep_plan_of`` keep their plan.
    """
    rows = running(events, ["workspaceid"], [F.asc("idx")], {"prev_planid": Previous(F.col("planid"))}, slice_by)
    moves = (F.col("eventname") == labels.reset) & (F.col("planid") != F.col("prev_planid"))
    itself = F.struct(F.col("planid").alias("plan"), F.lit(0).alias("kind"), F.lit(None).cast("string").alias("new"))
    moved = F.struct(F.col("prev_planid").alias("plan"), F.lit(1).alias("kind"), F.col("planid").alias("new"))
    probes = rows.withColumn("_p", F.explode(F.when(moves, F.array(itself, moved)).otherwise(F.array(itself))))
    probes = probes.withColumn("_plan", F.col("_p.plan"))
    order = [F.asc("idx"), F.asc("_p.kind")]
    found = running(probes, ["workspaceid", "_plan"], order, {"reset_planid": LatestOfAll(F.col("_p.new"))}, slice_by)
    found = found.where("_p.kind = 0").drop("_p", "_plan")
    found = found.withColumn("reset_planid", F.when(F.col("workspaceid").isNotNull(), F.col("reset_planid")))
    plan = F.coalesce("reset_planid", "planid")
    if keep_plan_of:
        plan = F.when(F.col("eventid").isin(*keep_plan_of), F.col("planid")).otherwise(plan)
    return found.withColumn("planid", plan)


OUTPUT = [c for c in COLUMNS if c != "logmicrosecondstamp"] + ["idx", "idx_inverse"]


def gather(
    v1: DataFrame,
    v2: DataFrame,
    custom: DataFrame,
    subscription: DataFrame,
    labels: Labels = SUBSCRIPTION,
    hot: Sequence = (),
) -> DataFrame:
    """All events in one shape, equal rows once, those of a workspace together.

    The second log is shuffled by workspace for its relabelling. The others are
    brought to the same partitioning, which the union keeps: from here on no
    event is shuffled again. Of ``hot`` workspaces all logs are cut into slices
    together; the result carries their slice column.
    """
    renamed = drop_redelivered(relabel_v2(v2, subscription, labels, hot))
    if hot:
        rows = from_v1(v1).unionByName(renamed.drop(SLICE)).unionByName(from_custom(custom)).distinct()
        return cut_slices(rows, "workspaceid", _asc(), "events-cut")
    first, own = from_v1(v1).repartition("workspaceid"), from_custom(custom).repartition("workspaceid")
    return first.unionByName(renamed).unionByName(own).distinct()


def finish_log(
    events: DataFrame, labels: Labels = SUBSCRIPTION, keep_plan_of: Sequence[str] = (), slice_by: str | None = None
) -> DataFrame:
    """Gathered events with final names, plans and positions."""
    rows = relabel_events(index_events(events, slice_by), labels)
    rows = remap_migrated(rows, slice_by).withColumn("eventname", F.col("_named"))
    rows = remap_reset(rows, labels, keep_plan_of, slice_by)
    return rows.select(*OUTPUT, *([slice_by] if slice_by else []))
