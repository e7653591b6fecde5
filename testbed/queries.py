"""Every operator as a query over the test tables, each with its SQL check.

``@check(sql)`` registers a function of ``Tables`` under its own name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import dates, money
from ledgerline.functions.identity import contact_kind as kind_of
from ledgerline.functions.identity import mask_contact as masked
from ledgerline.functions.identity import surrogate_id as stable_id
from ledgerline.operators import intervals, matching
from ledgerline.operators.hot import SLICE, apart, hot_keys, only, without
from ledgerline.operators.running import Previous, SumSoFar, running_measured
from ledgerline.plans import billing, daily, events, periods, referral, titles
from ledgerline.plans.events import PLAN, SUBSCRIPTION
from ledgerline.sources import tables
from ledgerline.sources.versions import Versions
from testbed.adapters import AS_OF, Tables
from testbed.oracle import (
    _CUSTOM,
    _DEPTHS,
    _EVENT_COLUMNS,
    _LOG_COLUMNS,
    _PLAN,
    _V1,
    BATCH,
    NOUNS,
    PLAN_LABELS,
    TEXT_WORDS,
    _first_category,
    _pattern,
    _tax,
    query,
)

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLE: dict[str, str] = {}
LABELS: dict[str, tuple[str, str]] = {}


def check(sql: str | None, labels: tuple[str, str] | None = None):
    def register(fn):
        name = fn.__name__
        QUERIES[name] = fn
        if labels:
            LABELS[name] = labels
        if sql is not None:
            ORACLE[name] = query(sql, *(labels or ()))
        return fn

    return register


def at(text: str):
    return F.lit(text).cast("timestamp_ntz")


# Sources and sinks ---------------------------------------------------------


@check(
    "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation"
)
def dimension_load(t):
    path = tables.stage_path(t.spark, "nation-sheet")
    nation = t.raw("nation")
    nation.toDF(*[c.upper() for c in nation.columns]).write.csv(path, header=True)
    return tables.load_dimension(t.spark, path)


@check("SELECT id, workspaceid, status FROM subscription UNION ALL SELECT id, workspaceid, eventname AS status FROM custom_eventlog")
def append_rows(t):
    path = tables.stage_path(t.spark, "append-rows")
    tables.append_rows(t.subscription, path)
    tables.append_rows(t.custom_eventlog.select(F.col("id").alias("ID"), "workspaceid", F.col("eventname").alias("Status")), path)
    return t.spark.read.parquet(path)


@check("SELECT * FROM test_workspaces")
def replace_table(t):
    path = tables.stage_path(t.spark, "replace-table")
    tables.replace_table(t.member.select("workspaceid"), path)
    tables.replace_table(billing.excluded_workspaces(t.test_user, t.member), path)
    return t.spark.read.parquet(path)


@check("SELECT * FROM kept_participants")
def participants_delete(t):
    return referral.participants_delete(t.participant_data, staged(t))


@check("SELECT * FROM viral_effect_analysis WHERE id IS NOT NULL")
def delete_where(t):
    return tables.delete_where(t.viral_effect_analysis, F.col("id").isNull())


@check(
    "SELECT id, CAST(NULL AS VARCHAR) AS idprovidertype, profilename, CAST(NULL AS TIMESTAMP) AS updatedat FROM viral_effect_analysis"
)
def conform_schema(t):
    schema = T.StructType(
        [
            T.StructField("id", T.StringType()),
            T.StructField("idprovidertype", T.StringType()),
            T.StructField("profilename", T.StringType()),
            T.StructField("updatedat", T.TimestampNTZType()),
        ]
    )
    return tables.conform(t.viral_effect_analysis, schema)


@check("SELECT * FROM document WHERE id NOT IN (SELECT documentid FROM document_category)")
def append_new(t):
    return tables.append_new(t.document, t.document_category.withColumnRenamed("documentid", "id"), "id")


# Projections and filters ---------------------------------------------------


@check(f"SELECT {_V1} FROM subscription_event_log")
def project_rename(t):
    return events.from_v1(t.subscription_event_log)


@check(f"SELECT {_CUSTOM} FROM custom_eventlog")
def constant_columns(t):
    return events.from_custom(t.custom_eventlog)


@check(
    """SELECT entity, CAST(due AS TIMESTAMP) AS due, CAST(viewed AS TIMESTAMP) AS viewed,
    CAST(signingduration AS BIGINT) AS signingduration, CAST(CAST(signingduration AS BIGINT) AS DOUBLE) / 60 AS minutes,
    CAST(createddate AS DATE) AS day FROM document_service"""
)
def casts(t):
    return t.document_service.select(
        "entity",
        F.try_to_timestamp("due").cast("timestamp_ntz").alias("due"),
        F.try_to_timestamp("viewed").cast("timestamp_ntz").alias("viewed"),
        F.col("signingduration").try_cast("bigint").alias("signingduration"),
        (F.col("signingduration").try_cast("double") / 60).alias("minutes"),
        F.col("createddate").try_cast("date").alias("day"),
    )


@check(
    """SELECT invoiceid, paymentid, adj, diff, sum(diff) OVER (PARTITION BY workspaceid ORDER BY createdat, invoiceid DESC, paymentid
      ROWS UNBOUNDED PRECEDING) - diff AS before FROM (
    SELECT b.id AS invoiceid, paymentid, workspaceid, createdat, -refundedamount AS adj,
      CASE WHEN refundedamount IS NULL THEN greatest(finalamount, NULL, 1) ELSE finalamount - refundedamount END AS diff FROM base b)"""
)
def lateral_alias(t):
    money = T.DecimalType(27, 8)
    one = F.lit(1).cast(money)
    rows = (
        tables.stage(daily.invoice_base(t), "invoice-base")
        .withColumnRenamed("id", "invoiceid")
        .withColumn("adj", -F.col("refundedamount"))
        .withColumn(
            "diff",
            F.when(F.col("adj").isNull(), F.greatest("finalamount", F.lit(None).cast(money), one))
            .otherwise(F.col("finalamount") + F.col("adj"))
            .cast(money),
        )
    )
    order = [F.asc_nulls_last("createdat"), F.desc_nulls_first("invoiceid"), F.asc("paymentid")]
    rows = running_measured(rows, ["workspaceid"], dates.epoch_seconds(F.col("createdat")), order, {"_sum": SumSoFar(F.col("diff"))})
    return rows.select("invoiceid", "paymentid", "adj", "diff", (F.col("_sum") - F.col("diff")).alias("before"))


@check(
    """SELECT id, CASE WHEN eventname = 'SUBSCRIPTION_TERMINATED' THEN 'SUBSCRIPTION_STOPPED' WHEN maxtimes = -1 THEN 'UNLIMITED'
    WHEN renewalcount >= 0 THEN 'RENEWING' ELSE eventname END AS label,
    CASE subscribingplanplaninterval WHEN 'MONTH' THEN 1 WHEN 'YEAR' THEN 12 END AS resets FROM subscription_event_log_v2"""
)
def case_label(t):
    label = (
        F.when(F.col("eventname") == events.TERMINATED, events.STOPPED)
        .when(F.col("maxtimes") == -1, "UNLIMITED")
        .when(F.col("renewalcount") >= 0, "RENEWING")
        .otherwise(F.col("eventname"))
    )
    interval = F.col("subscribingplanplaninterval")
    return t.subscription_event_log_v2.select(
        "id", label.alias("label"), F.when(interval == "MONTH", 1).when(interval == "YEAR", 12).alias("resets")
    )


@check(
    """SELECT i.id, CAST(b.unit AS BIGINT) AS price, CAST(w.whole AS BIGINT) AS origin_price
    FROM payment_invoice_item i JOIN subscription_plan p ON p.id = i.planid
    LEFT JOIN price_book b ON b.title = i.title AND b.resets = p.suppliedresetcount
    LEFT JOIN (SELECT title, NULL AS only, max(whole) AS whole FROM price_book WHERE title <> 'Premium' GROUP BY title
      UNION ALL SELECT title, resets, whole FROM price_book WHERE title = 'Premium') w
      ON w.title = i.title AND (w.only IS NULL OR w.only = p.suppliedresetcount)"""
)
def price_book(t):
    plan = t.subscription_plan.select(F.col("id").alias("planid"), "suppliedresetcount")
    title, resets = F.col("title"), F.col("suppliedresetcount")
    return t.payment_invoice_item.join(plan, "planid").select(
        "id", money.unit_price(title, resets).alias("price"), money.full_price(title, resets).alias("origin_price")
    )


@check("SELECT * FROM items")
def item_priority(t):
    return billing.first_items(t.payment_invoice_item)


@check("SELECT * FROM payment_service WHERE status <> 'FAILED'")
def filter_basic(t):
    return t.payment_service.where(F.col("status") != "FAILED")


@check(
    "SELECT * FROM custom_eventlog WHERE eventname IN ('PLAN_MIGRATION_2022_01', 'PLAN_MIGRATION_2022_03', 'PLAN_MIGRATION_2022_11')"
)
def filter_in_list(t):
    return t.custom_eventlog.where(F.col("eventname").isin(*events.MIGRATIONS))


@check("SELECT * FROM payment_invoice_item WHERE planid IS NOT NULL AND pluginaction IS NULL")
def filter_null(t):
    return t.payment_invoice_item.where(F.col("planid").isNotNull() & F.col("pluginaction").isNull())


@check(
    """SELECT entity, contact, CASE WHEN contact LIKE '%.%' OR contact LIKE '%@%' THEN 'email' ELSE 'kakao' END AS contactinfo
    FROM document_service"""
)
def contact_kind(t):
    return t.document_service.select("entity", "contact", kind_of(F.col("contact")).alias("contactinfo"))


@check(
    f"""SELECT planid, {_PLAN}, {_DEPTHS} FROM plans_left WHERE CASE WHEN depth2_name = 'Trial Plan' THEN FALSE
    WHEN depth5_name = 'Free' THEN FALSE WHEN depth1_name = 'Test' THEN FALSE ELSE TRUE END"""
)
def case_predicate(t):
    keep = (
        F.when(F.col("depth2_name") == "Trial Plan", False)
        .when(F.col("depth5_name") == "Free", False)
        .when(F.col("depth1_name") == "Test", False)
        .otherwise(True)
    )
    return daily.plan_attributes(t).where(keep)


@check("SELECT id, planid, nextplanid FROM subscription_event_log WHERE coalesce(planid, '') <> coalesce(nextplanid, '')")
def null_safe_differs(t):
    differs = F.coalesce("planid", F.lit("")) != F.coalesce("nextplanid", F.lit(""))
    return t.subscription_event_log.select("id", "planid", "nextplanid").where(differs)


@check(
    f"""SELECT entity, createddate FROM document_service WHERE __en = 'Participant'
    AND createddate >= strftime(TIMESTAMP '{BATCH}' + INTERVAL 9 HOUR - INTERVAL 1 MONTH, '%Y-%m-%d')"""
)
def recent_window(t):
    since = dates.recent_since(at(BATCH))
    return tables.scan_entities(t.document_service, referral.KIND, since).select("entity", "createddate")


@check(
    """SELECT 'clean list' AS list, id FROM user_service WHERE id NOT IN (SELECT id FROM viral_effect_analysis WHERE id IS NOT NULL)
    UNION ALL SELECT 'list with NULL', id FROM user_service WHERE id NOT IN (SELECT id FROM viral_effect_analysis)"""
)
def not_in_subquery(t):
    users = t.user_service.select("id")
    listed = t.viral_effect_analysis
    clean = matching.not_in(users, "id", listed.where(F.col("id").isNotNull()))
    dirty = matching.not_in(users, "id", listed)
    return clean.select(F.lit("clean list").alias("list"), "id").union(dirty.select(F.lit("list with NULL"), "id"))


@check(
    "SELECT * FROM payment_invoice_item WHERE CASE WHEN planid IN (SELECT planid FROM test_plans) THEN FALSE ELSE TRUE END"
)
def case_in_subquery(t):
    plans = billing.excluded_plans(daily.plan_attributes(t, "inner"))
    items = t.payment_invoice_item
    return items.join(plans, "planid", "left_anti").select(*items.columns)


@check("SELECT id, participantid, activatedat, signingat FROM either WHERE activatedat > signingat")
def signup_after_touch(t):
    pairs = match_either_key(t)
    return pairs.where(F.col("activatedat") > F.col("signingat")).select("id", "participantid", "activatedat", "signingat")


# Joins ---------------------------------------------------------------------


@check("SELECT m.userid, m.workspaceid, t.id FROM member m JOIN test_user t ON t.userid = m.userid")
def join_inner(t):
    return t.member.join(t.test_user, "userid").select("userid", "workspaceid", "id")


@check(
    """SELECT i.id, p.id AS paymentid, i.finalamount FROM payment_invoice i JOIN payment_service p
    ON p.invoiceid = i.id AND p.status <> 'FAILED' AND i.finalamount > 0"""
)
def join_residual(t):
    i, p = t.payment_invoice, t.payment_service
    on = (p["invoiceid"] == i["id"]) & (p["status"] != "FAILED") & (i["finalamount"] > 0)
    return i.join(p, on).select(i["id"], p["id"].alias("paymentid"), i["finalamount"])


@check(
    """SELECT c.planid, c.type, v.name FROM subscription_plan_category c
    LEFT JOIN subscription_plan_category_value v ON v.id = c.plancategoryvalueid"""
)
def join_left(t):
    value = t.subscription_plan_category_value.withColumnRenamed("id", "plancategoryvalueid")
    return t.subscription_plan_category.join(value, "plancategoryvalueid", "left").select("planid", "type", "name")


@check("SELECT eventid, mapped_planid FROM migrated")
def join_left_range(t):
    return remapped(t).select("eventid", "mapped_planid")


@check(
    f"""SELECT i.id, i.createdat, s.planid, s.subscription_start, s.subscription_end FROM payment_invoice i
    LEFT JOIN periods s ON s.workspaceid = i.workspaceid AND s.subscription_start <= i.createdat
      AND i.createdat < coalesce(s.subscription_end, TIMESTAMP '{AS_OF}' + INTERVAL 9 HOUR) AND i.type <> 'ONETIME'"""
)
def join_interval(t):
    runs = tables.stage(daily.subscription_periods(t), "periods")
    until = F.coalesce("subscription_end", dates.local_time(at(AS_OF)))
    spans = runs.withColumn("_until", until).select("workspaceid", "planid", "subscription_start", "subscription_end", "_until")
    both = t.payment_invoice.select("workspaceid").union(spans.select("workspaceid"))
    hot = hot_keys(both, "workspaceid")

    def join(rows, part, keys):
        return intervals.interval_join(
            rows,
            part,
            "workspaceid",
            "createdat",
            "subscription_start",
            "_until",
            ["planid", "subscription_start", "subscription_end"],
            F.col("type") != "ONETIME",
            keys,
        ).drop(SLICE)

    found = apart(
        t.payment_invoice,
        "workspaceid",
        hot,
        lambda rows: join(rows, without(spans, "workspaceid", hot), []),
        lambda rows: join(rows, only(spans, "workspaceid", hot), hot),
    )
    return found.select("id", "createdat", "planid", "subscription_start", "subscription_end")


@check("SELECT * FROM ends")
def next_change(t):
    groups = daily.staged_groups(t)
    return periods.next_change(periods.period_starts(groups.rows), groups.rows, groups.hot)


@check(
    """SELECT p.paymentid, p.status, p.datevalue, h.id AS paymenthistoryid FROM (
      SELECT id AS paymentid, status, createdat AS datevalue FROM payment_service
      UNION ALL SELECT paymentid, 'REFUNDED', refundedat FROM payment_refund_info) p
    LEFT JOIN (SELECT *, count(*) OVER (PARTITION BY paymentid) AS n FROM payment_history) h
    ON h.paymentid = p.paymentid AND h.paymentstatus = p.status AND (
      date_trunc('second', p.datevalue) = date_trunc('second', h.timestamp)
      OR abs(date_diff('second', date_trunc('second', p.datevalue), date_trunc('second', h.timestamp))) <= 5
      OR (h.n = 1 AND abs(date_diff('minute', p.datevalue, h.timestamp)) <= 1))"""
)
def join_tolerance(t):
    paid = t.payment_service.select(F.col("id").alias("paymentid"), "status", F.col("createdat").alias("datevalue"))
    refunded = t.payment_refund_info.select("paymentid", F.lit("REFUNDED").alias("status"), F.col("refundedat").alias("datevalue"))
    return matching.nearby_history(paid.unionByName(refunded), t.payment_history)


@check("SELECT u.* FROM user_service u LEFT JOIN test_user t ON t.userid = u.id WHERE t.id IS NULL")
def join_anti(t):
    test = t.test_user.select(F.col("userid").alias("id"))
    return t.user_service.join(test, "id", "left_anti")


@check("SELECT * FROM either")
def match_either_key(t):
    return referral.match_either_key(first_touch(t), t.user_service, ["profilesurveyphonenumber", "profileemail"])


# Aggregates ----------------------------------------------------------------


@check("SELECT * FROM refunds")
def refund_totals(t):
    return billing.refund_totals(t.payment_refund_info)


@check("SELECT DISTINCT planid, transactiontype FROM payment_invoice_item")
def distinct_keys(t):
    return t.payment_invoice_item.select("planid", "transactiontype").distinct()


@check(f"SELECT planid, {_PLAN}, {_DEPTHS} FROM plans_left")
def plan_category_pivot(t):
    return daily.plan_attributes(t)


@check(
    """SELECT c.invoiceid, max(CASE WHEN v.level = '1' THEN v.labelcode END) AS depth1_name,
    max(CASE WHEN v.level = '2' THEN v.labelcode END) AS depth2_name, max(CASE WHEN v.level = '3' THEN v.labelcode END) AS depth3_name
    FROM invoice_category c JOIN invoice_category_value v ON v.value = c.invoicecategoryvalueid GROUP BY c.invoiceid"""
)
def invoice_category_pivot(t):
    return billing.invoice_levels(t.invoice_category, t.invoice_category_value)


# Windows -------------------------------------------------------------------


@check(
    """SELECT l.id, lag(l.renewalcount) OVER w AS prev_renewalcount, lag(l.appliedplanplanid) OVER w AS prev_planid,
      lag(coalesce(l.appliedplanplanid, 'none')) OVER w AS prev_or_none
    FROM subscription_event_log_v2 l WINDOW w AS (PARTITION BY l.subscriptionid ORDER BY l.logdatetimestamp, l.id)"""
)
def lag_values(t):
    plan = F.col("appliedplanplanid")
    found = running_measured(
        t.subscription_event_log_v2,
        ["subscriptionid"],
        dates.epoch_seconds(F.col("logdatetimestamp")),
        [F.asc_nulls_last("logdatetimestamp"), F.asc("id")],
        {
            "prev_renewalcount": Previous(F.col("renewalcount")),
            "prev_planid": Previous(plan),
            "prev_or_none": Previous(F.coalesce(plan, F.lit("none"))),
        },
    )
    return found.select("id", "prev_renewalcount", "prev_planid", "prev_or_none")


def named(t, labels=SUBSCRIPTION, finish=lambda rows: rows):
    def step(v1, v2, custom, subscription, hot):
        return finish(events.relabel_v2(v2, subscription, labels, hot))

    return daily.per_workspace(t, daily.hot_workspaces(t), step)


@check(f"SELECT {_EVENT_COLUMNS} FROM v2_kept")
def dedupe_events(t):
    return named(t, finish=events.drop_redelivered)


def unified(t):
    return daily.gathered(t, lambda rows, cut: rows)[0]


@check(f"SELECT {_EVENT_COLUMNS}, prev_nextplanid, idx, idx_inverse FROM positions")
def event_positions(t):
    return daily.gathered(t, events.index_events)[0].drop("_lastplanid")


@check("SELECT * FROM touches")
def first_touch(t):
    stored = referral.participants_refresh(t.participant_data, daily.staged_participants(t, at(BATCH)))
    return referral.first_touch(stored, t.document_creation)


@check(
    """SELECT documentid, participantid, due, CASE WHEN dense_rank() OVER (PARTITION BY documentid ORDER BY due NULLS LAST) = 1 THEN 1
    ELSE row_number() OVER (PARTITION BY documentid ORDER BY participantid, due, contact NULLS LAST) END AS ordinal FROM staged"""
)
def signing_order(t):
    rows = staged(t)
    return referral.signing_order(rows).select("documentid", "participantid", "due", "ordinal")


_BALANCE = """SELECT workspaceid, id AS invoiceid, createdat AS datevalue, finalamount,
  sum(finalamount) OVER (PARTITION BY workspaceid ORDER BY createdat, id DESC ROWS UNBOUNDED PRECEDING) - finalamount = 0
    AS subscription_initial_start_point FROM payment_invoice"""


@check(_BALANCE)
def running_balance_start(t):
    order = [F.asc_nulls_last("createdat"), F.desc_nulls_first("id")]
    seconds = dates.epoch_seconds(F.col("createdat"))
    rows = running_measured(t.payment_invoice, ["workspaceid"], seconds, order, {"_sum": SumSoFar(F.col("finalamount"))})
    return rows.select(
        "workspaceid",
        F.col("id").alias("invoiceid"),
        F.col("createdat").alias("datevalue"),
        "finalamount",
        (F.col("_sum") - F.col("finalamount") == 0).alias("subscription_initial_start_point"),
    )


def _balance_calendar(t):
    rows = running_balance_start(t).select(
        "*",
        F.lit("PAID").alias("status"),
        F.lit(None).cast("string").alias("paymentid"),
        F.lit(None).cast("timestamp_ntz").alias("subscription_start"),
    )
    return billing.billing_calendar(rows, hot_keys(t.payment_invoice, "workspaceid"))


@check(
    "SELECT invoiceid, "
    + ", ".join(
        f"max(CAST(subscription_initial_start_point AS INT)) OVER (PARTITION BY workspaceid, date_trunc('{u}', datevalue)) = 1 AS new_yn_{u}"
        for u in ("year", "quarter", "month")
    )
    + f" FROM ({_BALANCE})"
)
def calendar_new_flags(t):
    return _balance_calendar(t).select("invoiceid", "new_yn_year", "new_yn_quarter", "new_yn_month")


@check(
    "SELECT id AS invoiceid, "
    + ", ".join(
        f"1.0::DOUBLE / count(*) OVER (PARTITION BY workspaceid, date_trunc('{u}', createdat)) AS workspace_all_count_{u}"
        for u in ("year", "quarter", "month")
    )
    + " FROM payment_invoice"
)
def calendar_weights(t):
    found = _balance_calendar(t)
    return found.select("invoiceid", *[f"workspace_all_count_{u}" for u in billing.CALENDAR])


@check("SELECT * EXCLUDE (n) FROM (SELECT *, count(*) OVER (PARTITION BY paymentid) AS n FROM payment_history) WHERE n = 1")
def unique_gate(t):
    return matching.sole_rows(t.payment_history, "paymentid")


# Set operations ------------------------------------------------------------


@check(f"SELECT {_EVENT_COLUMNS} FROM stacked")
def union_all_logs(t):
    return events.from_v1(t.subscription_event_log).unionByName(dedupe_events(t))


@check(
    """SELECT eventid, workspaceid, eventname, planid FROM stacked UNION ALL SELECT eventid, workspaceid, eventname, planid FROM stacked
    UNION SELECT id, workspaceid, eventname, planid FROM custom_eventlog"""
)
def union_distinct_logs(t):
    columns = ["eventid", "workspaceid", "eventname", "planid"]
    logs = union_all_logs(t).select(*columns)
    custom = events.from_custom(t.custom_eventlog).select(*columns)
    return logs.union(logs).union(custom).distinct()


# Scalar functions ----------------------------------------------------------


@check(
    """SELECT entity, split_part(entity, '#', 2) AS part, substring(entity, 13) AS tail, substring(entity, 1, 11) AS head,
    locale || '-' || signingmethod AS joined, trim('  ' || type || ' ') AS trimmed FROM document_service"""
)
def string_funcs(t):
    return t.document_service.select(
        "entity",
        F.split_part("entity", F.lit("#"), F.lit(2)).alias("part"),
        F.substring("entity", 13, 2**31 - 1).alias("tail"),
        F.substring("entity", 1, 11).alias("head"),
        F.concat("locale", F.lit("-"), "signingmethod").alias("joined"),
        F.trim(F.concat(F.lit("  "), "type", F.lit(" "))).alias("trimmed"),
    )


@check(
    """SELECT entity, CASE WHEN contact LIKE '%.%' OR contact LIKE '%@%'
      THEN sha256(split_part(contact, '@', 1)) || '@' || split_part(contact, '@', 2) ELSE sha256('+82' || substring(contact, 2)) END AS masked
    FROM document_service"""
)
def mask_contact(t):
    contact = F.col("contact")
    return t.document_service.select("entity", masked(contact, kind_of(contact)).alias("masked"))


@check("SELECT id, substring(md5(workspaceid || '|' || id), 1, 32) AS rowid FROM subscription_event_log")
def surrogate_id(t):
    return t.subscription_event_log.select("id", stable_id(F.col("workspaceid"), F.col("id")).alias("rowid"))


@check(
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, CAST(floor(epoch(ts)) AS BIGINT) AS seconds, CAST(day(ts) AS INT) AS dayno,
    date_trunc('year', ts) AS y, date_trunc('quarter', ts) AS q, date_trunc('month', ts) AS m, date_trunc('day', ts) AS d,
    date_trunc('second', ts) AS s, last_day(ts) AS month_end, ts + INTERVAL 1 MONTH AS in_a_month, ts + INTERVAL 40 DAY AS in_40_days,
    CAST(date_diff('minute', ts, ts + INTERVAL 90 SECOND) AS BIGINT) AS minutes FROM events"""
)
def date_funcs(t):
    ts = F.col("ts")
    later = ts + F.expr("INTERVAL '90' SECOND")
    return t.raw("events").select(
        "event_id",
        F.date_format(ts, "yyyy-MM-dd").alias("day"),
        dates.epoch_seconds(ts).alias("seconds"),
        F.dayofmonth(ts).alias("dayno"),
        dates.year_start(ts).alias("y"),
        dates.quarter_start(ts).alias("q"),
        dates.month_start(ts).alias("m"),
        dates.day_start(ts).alias("d"),
        F.date_trunc("second", ts).cast("timestamp_ntz").alias("s"),
        F.last_day(ts).alias("month_end"),
        dates.add_months(ts, 1).alias("in_a_month"),
        (ts + F.expr("INTERVAL '40' DAY")).alias("in_40_days"),
        dates.minutes_apart(ts, later).alias("minutes"),
    )


@check("SELECT eventid, logdatetimestamp, resetdateofmonth, nextresetdate FROM v2_named")
def next_reset_date(t):
    log = t.subscription_event_log_v2
    day = F.col("renewaldateofmonth")
    return log.select(
        F.col("id").alias("eventid"),
        "logdatetimestamp",
        day.alias("resetdateofmonth"),
        dates.next_reset_date(F.col("logdatetimestamp"), day).alias("nextresetdate"),
    )


@check("SELECT entity, createdat + INTERVAL 9 HOUR AS createdat FROM document_service")
def local_time_shift(t):
    return t.document_service.select("entity", dates.local_time(F.col("createdat")).alias("createdat"))


@check(f"SELECT id, {_tax('amount')} AS net, {_tax('-finalamount')} AS net_back FROM payment_invoice")
def tax_exclusive(t):
    return t.payment_invoice.select(
        "id",
        money.tax_exclusive(F.col("amount")).alias("net"),
        money.tax_exclusive(-F.col("finalamount")).alias("net_back"),
    )


# Subscription events -------------------------------------------------------


@check(f"SELECT {_EVENT_COLUMNS} FROM unified")
def unified_events(t):
    return unified(t)


@check(f"SELECT {_EVENT_COLUMNS} FROM v2_named", PLAN_LABELS)
def relabel_v2_events(t):
    return named(t, PLAN)


def remapped(t):
    def step(rows, cut):
        return events.remap_migrated(events.relabel_events(events.index_events(rows, cut)), cut)

    return daily.gathered(t, step)[0]


@check("SELECT eventid, workspaceid, idx, coalesce(mapped_planid, planid) AS planid FROM migrated")
def migration_remap(t):
    return remapped(t).select("eventid", "workspaceid", "idx", "planid")


@check("SELECT eventid, eventname FROM step1")
def event_relabel(t):
    found, _ = daily.gathered(t, lambda rows, cut: events.relabel_events(events.index_events(rows, cut)))
    return found.select("eventid", F.col("_named").alias("eventname"))


@check(f"SELECT {_LOG_COLUMNS} FROM log")
def reset_plan_remap(t):
    return daily.event_log(t)


@check("SELECT * FROM rec")
def plan_groups(t):
    groups, _ = daily.plan_groups(t)
    return groups.select(
        "eventid", "workspaceid", "eventname", "logdatetimestamp", "logtimestamp", "planid", "group_planid", "idx", "group_number"
    )


@check("SELECT * FROM starts")
def period_starts(t):
    groups, _ = daily.plan_groups(t)
    return periods.period_starts(groups)


@check("SELECT * FROM periods")
def subscription_periods(t):
    return daily.subscription_periods(t)


_BASIC = """SELECT md5(workspaceid || '|' || eventid || '|' || CAST(idx AS VARCHAR)) AS id, workspaceid, eventid,
  logdatetimestamp AS subscription_start, CAST(NULL AS TIMESTAMP) AS subscription_end, CAST(NULL AS TIMESTAMP) AS expected_subscription_end,
  planid, TRUE AS issubscribing, CAST(NULL AS TIMESTAMP) AS nextresetdate, 1 AS resetdateofmonth, 1 AS remainingresetcount, 0 AS currenttimes,
  100 AS maxtimes, 'Portfolio Plan' AS title, 1 AS grade, CAST(10000 AS BIGINT) AS price, 1 AS resetperiodvalue, 1 AS suppliedresetcount,
  1 AS planversion, """ + ", ".join(f"CAST(NULL AS VARCHAR) AS depth{n}_name" for n in range(1, 6))


@check(f"{_BASIC} FROM rec", PLAN_LABELS)
def subscription_periods_basic(t):
    groups, _ = daily.plan_groups(t, PLAN)
    return periods.basic_periods(groups)


# Billing -------------------------------------------------------------------


@check("SELECT planid FROM test_plans")
def excluded_plans(t):
    return billing.excluded_plans(daily.plan_attributes(t, "inner"))


@check("SELECT workspaceid FROM test_workspaces")
def excluded_workspaces(t):
    return billing.excluded_workspaces(t.test_user, t.member)


@check("SELECT * FROM base")
def invoice_base(t):
    return daily.invoice_base(t)


@check("SELECT * FROM vouchers")
def voucher_positions(t):
    base = tables.stage(daily.invoice_base(t), "invoice-base")
    return billing.voucher_positions(base, daily.plan_attributes(t, "inner"), hot_keys(base, "workspaceid"))


@check("SELECT * FROM allocated")
def voucher_allocation(t):
    return billing.voucher_allocation(voucher_positions(t))


@check("SELECT * FROM adjusted")
def invoice_adjusted(t):
    return daily.invoice_adjusted(t, at(AS_OF))[0]


def _ledger(t):
    adjusted, hot = daily.invoice_adjusted(t, at(AS_OF))
    return billing.billing_ledger(tables.stage(adjusted, "invoice-adjusted"), t.payment_refund_info), hot


@check("SELECT * FROM ledger")
def billing_ledger(t):
    return _ledger(t)[0]


@check("SELECT * FROM calendar")
def billing_calendar(t):
    return billing.billing_calendar(*_ledger(t))


@check("SELECT * FROM matched")
def billing_matched(t):
    return billing.billing_matched(billing_calendar(t), t.payment_history)


_RAWDATA = ", ".join(
    f"CAST({c} AS DECIMAL(19,8)) AS {c}" for c in ("amount", "finalamount", "refundedamount", "finalamount_diff")
) + ", " + ", ".join(f"CAST(workspace_all_count_{u} AS DECIMAL(19,10)) AS workspace_all_count_{u}" for u in billing.CALENDAR)


@check(
    f"""SELECT purchaseitemcategory, workspaceid, invoiceid, paymentid, paymenthistoryid, purchaseitemid, status, {_RAWDATA},
    subscription_initial_start_point, type, invoicetype, datevalue, planid, extracharge_planid, featureusageaction, pluginaction,
    invoice_subscription_start, invoice_subscription_end, invoicecreatedat, createdat, refundedat, subscription_start, subscription_end,
    prev_datevalue, new_yn_year, new_yn_quarter, new_yn_month FROM matched"""
)
def billing_rawdata(t):
    return daily.billing_rawdata(t, at(AS_OF))


# Referral ------------------------------------------------------------------


def staged(t):
    return referral.participants_stage(t.document_service, at(BATCH))


@check("SELECT * FROM staged")
def participants_stage(t):
    return staged(t)


@check("SELECT * FROM refreshed")
def participants_refresh(t):
    return referral.participants_refresh(t.participant_data, daily.staged_participants(t, at(BATCH)))


@check("SELECT * FROM attributed")
def referral_attribution(t):
    return daily.referral_attribution(t, at(BATCH))[1]


@check(
    """SELECT documentid, participantid, contact, type, ordinal AS "order", contactinfo, signingmethod, locale,
      due AS "to", viewed AS "from", signingduration, createdat FROM refreshed"""
)
def participants_table(t):
    source = t.document_service.withColumnsRenamed({"due": "to", "viewed": "from"})
    stored = referral.participants_table(t.participant_data)
    staged_ = tables.stage(referral.participants_stage(source, at(BATCH)), "participants-stage")
    return referral.participants_table(referral.participants_refresh(stored, staged_))


NOT_KNOWN = [c for c in referral.USER if c.startswith("profilesurvey") and c not in ("profilesurveycompanycategory", "profilesurveyphonenumber")]


@check(
    f"""SELECT {", ".join(referral.TOUCH)}, id, idprovidertype, profileemail, profilename, profilesurveycompanycategory,
      profilesurveyphonenumber, {", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in NOT_KNOWN)},
      activatedat, createdat, CAST(NULL AS TIMESTAMP) AS updatedat FROM attributed"""
)
def attribution_table(t):
    return referral.attribution_table(daily.referral_attribution(t, at(BATCH))[1])


@check(
    "SELECT id, status FROM (SELECT id, status FROM subscription UNION ALL SELECT id, eventname FROM custom_eventlog)"
)
def version_rows(t):
    versions = Versions(t.spark, tables.stage_path(t.spark, "versions"))
    with versions.writing("one") as path:
        tables.replace_table(t.subscription.select("id", "status"), f"{path}/rows")
    with versions.writing("two") as path:
        tables.replace_table(t.custom_eventlog.select("id", F.col("eventname").alias("status")), f"{path}/rows")
    return versions.all_rows("rows")


# Titles --------------------------------------------------------------------


def dictionary(t):
    rows = [(noun, *pair) for noun, pair in NOUNS.items()]
    return t.spark.createDataFrame(rows, "noun string, category1 string, category2 string")


def _new_documents(t):
    return daily.titles_of_documents(t, t.document_category)


def _new_templates(t):
    return daily.titles_of_templates(t, t.template_category)


@check("SELECT * FROM fresh_documents")
def titles_to_classify_docs(t):
    return _new_documents(t)


@check("SELECT * FROM fresh_templates")
def titles_to_classify_templates(t):
    return _new_templates(t)


@check(f"SELECT doc_id, array_to_string(regexp_extract_all(text, '{_pattern(TEXT_WORDS)}', 1), ',') AS nouns FROM documents")
def title_nouns(t):
    found = t.raw("documents").select("doc_id", titles.title_nouns(F.col("text"), list(TEXT_WORDS)).alias("nouns"))
    return titles.nouns_as_text(found)


_NOUNS_TEXT = "array_to_string(nouns, ',') AS nouns"
_DOC = f"SELECT documentid, userid, workspaceid, estimated_workspaceid, createdat, {_NOUNS_TEXT}"
_TEMPLATE = f"SELECT templateid, workspaceid, memberid, title, createdat, {_NOUNS_TEXT}"


@check(f"{_DOC}, {_first_category(0)} AS category1, {_first_category(1)} AS category2 FROM document_nouns")
def contract_category(t):
    return titles.nouns_as_text(titles.contract_categories(_new_documents(t), dictionary(t), "documentid"))


@check(f"{_TEMPLATE}, {_first_category(0)} AS category1, {_first_category(1)} AS category2 FROM template_nouns")
def template_contract_category(t):
    return titles.nouns_as_text(titles.contract_categories(_new_templates(t), dictionary(t), "templateid"))


@check(f"{_DOC}, {_first_category(0)} AS category1 FROM form_document_nouns")
def form_category(t):
    fresh = daily.titles_of_documents(t, t.document_form_category)
    return titles.nouns_as_text(titles.form_categories(fresh, dictionary(t), "documentid"))


@check(f"{_TEMPLATE}, {_first_category(0)} AS category1 FROM form_template_nouns")
def template_form_category(t):
    fresh = daily.titles_of_templates(t, t.template_form_category)
    return titles.nouns_as_text(titles.form_categories(fresh, dictionary(t), "templateid"))


def _part_words(t):
    word = F.split_part("p_name", F.lit(" "), F.lit(1)).alias("noun")
    return t.raw("part").groupBy(word).agg(F.max("p_brand").alias("brand"))


@check("SELECT split_part(p_name, ' ', 1) AS noun, max(p_brand) AS category1 FROM part GROUP BY split_part(p_name, ' ', 1)")
def category_map(t):
    """A category map of the words of part names, written as JSON lines of one noun each and loaded."""
    path = tables.stage_path(t.spark, "category-map")
    _part_words(t).select(F.to_json(F.create_map("noun", "brand")).alias("value")).write.text(path)
    return tables.load_category_map(t.spark, path, per_line=True)


@check("SELECT DISTINCT split_part(p_name, ' ', 1) AS noun FROM part")
def noun_list(t):
    """A noun list of the words of part names, written with their tags and loaded."""
    path = tables.stage_path(t.spark, "noun-list")
    gap = F.when(F.length("noun") % 2 == 0, "\t").otherwise("   ")
    _part_words(t).select(F.concat("noun", gap, F.lit("NNG")).alias("value")).write.text(path)
    return tables.load_noun_list(t.spark, path)
