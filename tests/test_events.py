import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ledgerline.functions.dates import next_reset_date
from ledgerline.plans import daily, events, periods
from ledgerline.plans.events import PLAN, SUBSCRIPTION

DAY = datetime(2024, 1, 1)
LOG = "eventid string, workspaceid string, eventname string, planid string, idx bigint, logtimestamp bigint, logdatetimestamp timestamp_ntz"
RENEWED, RESET, STOPPED, STARTED = "SUBSCRIPTION_RENEWED", "SUBSCRIPTION_RESET", "SUBSCRIPTION_STOPPED", "SUBSCRIPTION_STARTED"


def log_of(spark, steps, seconds=None):
    data = []
    for workspace, events_ in steps.items():
        for i, (name, plan) in enumerate(events_, 1):
            second = seconds[workspace][i - 1] if seconds else i
            data.append((f"{workspace}-{i}", workspace, name, plan, i, second, DAY + timedelta(seconds=second, microseconds=i)))
    return spark.createDataFrame(data, LOG)


def groups_of(spark, *steps):
    found = periods.plan_groups(log_of(spark, {"w": list(steps)})).orderBy("idx")
    return [(r["group_number"], r["planid"], r["group_planid"], r["eventid"]) for r in found.collect()]


def test_stop_and_restart_is_a_new_run(spark):
    found = groups_of(spark, (STARTED, "A"), (STOPPED, None), (STARTED, "A"))
    assert found == [(1, "A", "A", "w-1"), (1, None, "A", "w-1"), (2, "A", "A", "w-3")]


def test_renewal_without_plan_goes_on(spark):
    assert groups_of(spark, (STARTED, "A"), (RENEWED, None))[1] == (1, "A", "A", "w-1")


def test_reset_does_not_change_the_plan(spark):
    assert groups_of(spark, (STARTED, "A"), (RESET, "B"))[1] == (1, "A", "A", "w-2")


def test_first_event_without_plan(spark):
    assert groups_of(spark, (STOPPED, None), (RENEWED, "A")) == [(1, None, None, "w-1"), (2, "A", "A", "w-2")]


def fold(steps):
    """The runs of one workspace, event by event."""
    out = []
    for i, (name, plan) in enumerate(steps, 1):
        if i == 1:
            state = ("w-1", plan, plan, 1)
        else:
            eventid, now, _, number = state
            same = (now or "") == (plan or now or "")
            goes_on = name == RESET or (name == RENEWED and same)
            state = (
                f"w-{i}" if plan else eventid,
                now if goes_on else plan,
                now if goes_on else (plan or now),
                number + (0 if goes_on or same else 1),
            )
        out.append(state)
    return out


def random_steps(pick, n):
    return [(pick.choice([STARTED, RENEWED, RESET, STOPPED]), pick.choice([None, "A", "B", "C"])) for _ in range(n)]


def test_plan_groups_against_a_fold(spark):
    pick = random.Random(3)
    steps = {f"x{n}": random_steps(pick, pick.randint(1, 9)) for n in range(2000)}
    found = periods.plan_groups(log_of(spark, steps)).collect()
    got = {}
    for r in sorted(found, key=lambda r: r["idx"]):
        number = r["eventid"].split("-")[1]
        got.setdefault(r["workspaceid"], []).append((f"w-{number}", r["planid"], r["group_planid"], r["group_number"]))
    assert got == {name: fold(s) for name, s in steps.items()}


def test_next_change_with_ties_against_all_pairs(spark):
    pick = random.Random(5)
    steps = {f"x{n}": random_steps(pick, pick.randint(1, 12)) for n in range(600)}
    seconds = {name: sorted(pick.choices(range(6), k=len(s))) for name, s in steps.items()}
    groups = periods.plan_groups(log_of(spark, steps, seconds)).cache()
    starts = periods.period_starts(groups)
    e, s = groups.alias("e"), starts.alias("s")
    later = (F.col("e.workspaceid") == F.col("s.workspaceid")) & (F.col("e.logtimestamp") > F.col("s.logtimestamp_start"))
    other = F.coalesce("e.planid", F.lit("")) != F.col("s.planid")
    pairs = s.join(e, later & other).groupBy("s.eventid").agg(F.min("e.logdatetimestamp").alias("end_timestamp"))
    expected = sorted((r["eventid"], r["end_timestamp"]) for r in pairs.collect())
    busy = [f"x{n}" for n in range(0, 600, 2)]
    assert len(expected) > 500
    for hot in ([], busy):
        found = periods.next_change(starts, groups, hot).collect()
        assert sorted((r["eventid"], r["end_timestamp"]) for r in found) == expected


V2 = (
    "id string, subscriptionid string, logdatetimestamp timestamp_ntz, logmicrosecondstamp bigint, eventname string, "
    "appliedplanplanid string, renewalcount int, renewaldateofmonth int, subscribingplanplaninterval string, currenttimes int, maxtimes int"
)


def relabelled(spark, labels, *log):
    data = [
        (f"e{i}", "s1", DAY + timedelta(hours=i), 0, name, plan, count, 15, interval, 0, limit)
        for i, (name, plan, count, interval, limit) in enumerate(log)
    ]
    owner = spark.createDataFrame([("s1", "w1", "ACTIVE")], "id string, workspaceid string, status string")
    found = events.relabel_v2(spark.createDataFrame(data, V2), owner, labels).orderBy("eventid").collect()
    return [(r["eventname"], r["planid"], r["issubscribing"], r["plansuppliedresetcount"]) for r in found]


def test_relabel_v2_branches(spark):
    renewed = "APPLIED_PLAN_RENEWED"
    found = relabelled(
        spark,
        PLAN,
        (renewed, "A", 5, "YEAR", -1),
        (renewed, "A", 5, "MONTH", 3),
        (renewed, "B", 6, "MONTH", 3),
        (renewed, "B", 0, "YEAR", 3),
        (renewed, "B", -1, "YEAR", 3),
        ("SUBSCRIPTION_TERMINATED", "B", 0, "WEEK", 3),
        ("SOMETHING", "B", 0, "WEEK", None),
    )
    assert found == [
        ("PLAN_RESET", "A", True, 12),
        ("PLAN_RENEWED", "A", False, 1),
        ("SUBSCRIPTION_CHANGED", "B", False, 1),
        ("PLAN_RESET", "B", False, 12),
        ("PLAN_RENEWED", "B", False, 12),
        ("SUBSCRIPTION_STOPPED", None, False, None),
        ("SOMETHING", "B", None, None),
    ]
    assert relabelled(spark, SUBSCRIPTION, (renewed, "A", 5, "YEAR", 1))[0][0] == "SUBSCRIPTION_RESET"


def test_next_reset_date(spark):
    cases = [
        (datetime(2024, 1, 10, 7), 15, datetime(2024, 1, 15)),
        (datetime(2024, 1, 20, 7), 15, datetime(2024, 2, 15)),
        (datetime(2024, 1, 31, 7), 31, datetime(2024, 2, 29)),
        (datetime(2023, 2, 10, 7), 31, datetime(2023, 3, 3)),
    ]
    df = spark.createDataFrame(cases, "ts timestamp_ntz, day int, want timestamp_ntz")
    assert df.where(~next_reset_date(F.col("ts"), F.col("day")).eqNullSafe(F.col("want"))).isEmpty()


def chain(spark, *log):
    """(eventname, planid) after relabelling and remapping one workspace's log."""
    schema = (
        "eventid string, workspaceid string, logdatetimestamp timestamp_ntz, logtimestamp bigint, logmicrosecondstamp bigint, "
        "eventname string, planid string, nextplanid string"
    )
    data = [(f"e{i}", "w", DAY + timedelta(seconds=i), i, 0, name, plan, announced) for i, (name, plan, announced) in enumerate(log)]
    rows = events.relabel_events(events.index_events(spark.createDataFrame(data, schema)))
    rows = events.remap_migrated(rows).withColumn("eventname", F.col("_named")).drop("_named")
    return [(r["eventname"], r["planid"]) for r in events.remap_reset(rows).orderBy("idx").collect()]


def test_announced_change_and_its_reset(spark):
    found = chain(spark, (STARTED, "A", None), ("SUBSCRIPTION_CHANGED", "A", "B"), (RESET, "B", None))
    assert [name for name, _ in found] == [STARTED, "SUBSCRIPTION_NEXT_PLAN_CHANGED", "SUBSCRIPTION_CHANGED"]


def test_migration_renames_the_old_plan(spark):
    found = chain(spark, (STARTED, "A", None), (RENEWED, "A", None), ("PLAN_MIGRATION_2022_01", "M", None), (STARTED, "A", None))
    assert found == [(STARTED, "M"), (RENEWED, "M"), ("SNAPSHOT", "M"), (STARTED, "A")]


def test_reset_to_another_plan_renames_it_throughout(spark):
    found = chain(spark, (STARTED, "A", None), (RESET, "B", None), (STARTED, "A", None))
    assert [plan for _, plan in found] == ["B", "B", "B"]


class Without:
    """Tables with one of them empty, which only shows when the job runs."""

    def __init__(self, t, *names):
        self.t, self.names = t, names

    def __getattr__(self, name):
        df = getattr(self.t, name)
        return df.where("logdatetimestamp < timestamp_ntz'1900-01-01'") if name in self.names else df


def test_logs_may_be_empty(t):
    for gone in (["subscription_event_log_v2"], ["custom_eventlog"], ["subscription_event_log", "custom_eventlog"]):
        part = Without(t, *gone)
        found = daily.event_log(part)
        counts = found.groupBy("workspaceid").agg(F.count("*").alias("n"), F.max("idx").alias("last"), F.countDistinct("idx").alias("all"))
        assert counts.where("n = last AND n = all").count() == counts.count() > 0
