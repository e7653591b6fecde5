"""Business tables derived from the test tables, for Spark and for DuckDB.

Each view is one SELECT over whole raw tables, written once for both dialects;
only time functions differ. ``{events}`` and the like stand for the raw tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.sources.tables import read_table

RAW = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Moment the batch is taken to run at.
AS_OF = "2025-01-01 00:00:00"


class SparkDialect:
    name = "spark"

    @staticmethod
    def epoch(x):
        return f"unix_seconds(CAST({x} AS TIMESTAMP))"

    @staticmethod
    def micros(x):
        return f"unix_micros(CAST({x} AS TIMESTAMP))"

    @staticmethod
    def sha(x):
        return f"sha2({x}, 256)"

    @staticmethod
    def ts_text(x):
        return f"date_format({x}, 'yyyy-MM-dd HH:mm:ss')"

    @staticmethod
    def day_text(x):
        return f"date_format({x}, 'yyyy-MM-dd')"


class DuckDialect:
    name = "duckdb"

    @staticmethod
    def epoch(x):
        return f"CAST(floor(epoch({x})) AS BIGINT)"

    @staticmethod
    def micros(x):
        return f"epoch_us({x})"

    @staticmethod
    def sha(x):
        return f"sha256({x})"

    @staticmethod
    def ts_text(x):
        return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"

    @staticmethod
    def day_text(x):
        return f"strftime({x}, '%Y-%m-%d')"


def _s(x):
    return f"CAST({x} AS STRING)"


# Orders and shipments lie decades before the events; this brings them together.
_SHIFT = "INTERVAL '9000' DAY"
_TITLE = (
    "CASE {k} % 8 WHEN 0 THEN 'Starter Plan' WHEN 1 THEN 'Business Plan' WHEN 2 THEN 'Premium Plan' "
    "WHEN 3 THEN 'Voucher10' WHEN 4 THEN 'Voucher20' WHEN 5 THEN 'Voucher40' WHEN 6 THEN 'Premium' ELSE 'Basic' END"
)
_ITEM = (
    "'li-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING)"
    " || '-' || CAST(l_suppkey AS STRING) || '-' || {day}"
)


def views(d, renewed: str = "SUBSCRIPTION_RENEWED", reset: str = "SUBSCRIPTION_RESET") -> dict[str, str]:
    item = _ITEM.replace("{day}", d.day_text("l_shipdate"))
    invoice_time = f"o_orderdate + {_SHIFT} + (o_orderkey % 86400) * INTERVAL '1' SECOND"
    refund_time = f"l_shipdate + {_SHIFT} + (l_partkey % 3600) * INTERVAL '1' SECOND"
    contact = (
        f"CASE WHEN l_quantity = 50 THEN NULL WHEN l_partkey % 2 = 0 THEN 'user' || {_s('l_partkey')} || '@mail.com' "
        f"ELSE '0100000' || {_s('l_partkey')} END"
    )
    role = "CASE WHEN l_linenumber = 1 THEN 'EDITOR' WHEN l_linenumber % 2 = 0 THEN 'SIGNER' ELSE 'VIEWER' END"
    return {
        "subscription_event_log": f"""
SELECT 'v1-' || {_s('event_id')} AS id, 'w' || {_s('user_id')} AS workspaceid, ts AS logdatetimestamp,
  {d.epoch('ts')} AS logtimestamp, {d.micros('ts')} AS logmicrosecondstamp,
  CASE event_type WHEN 'signup' THEN 'SUBSCRIPTION_STARTED' WHEN 'purchase' THEN 'SUBSCRIPTION_CHANGED'
    WHEN 'click' THEN '{renewed}' WHEN 'view' THEN '{reset}' ELSE 'SUBSCRIPTION_STOPPED' END AS eventname,
  CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'click' AND event_id % 3 = 0 THEN NULL
    ELSE 'P' || {_s('event_id % 4')} END AS planid,
  CASE WHEN event_type = 'purchase' AND event_id % 3 = 0 THEN 'P' || {_s('(event_id + 1) % 4')} END AS nextplanid,
  value > 30 AS issubscribing, ts + (event_id % 28) * INTERVAL '1' DAY AS nextresetdate,
  CAST(1 + event_id % 31 AS INT) AS resetdateofmonth, CAST(1 + event_id % 2 AS INT) AS planresetperiodvalue,
  CAST(1 + event_id % 12 AS INT) AS plansuppliedresetcount, CAST(event_id % 13 AS INT) AS remainingresetcount,
  CAST(event_id % 100 AS INT) AS currenttimes, CAST(100 AS INT) AS maxtimes
FROM {{events}}""",
        "subscription_event_log_v2": f"""
SELECT tag || {_s('event_id')} AS id, 's' || {_s('user_id')} AS subscriptionid,
  ts + INTERVAL '12' HOUR AS logdatetimestamp, {d.micros("ts + INTERVAL '12' HOUR")} AS logmicrosecondstamp,
  CASE event_type WHEN 'error' THEN 'SUBSCRIPTION_TERMINATED' WHEN 'purchase' THEN 'SUBSCRIPTION_STARTED'
    ELSE 'APPLIED_PLAN_RENEWED' END AS eventname,
  'P' || {_s('event_id % 4')} AS appliedplanplanid, CAST(event_id % 13 - 1 AS INT) AS renewalcount,
  CAST(1 + event_id % 31 AS INT) AS renewaldateofmonth,
  CASE WHEN event_id % 3 = 0 THEN 'YEAR' WHEN event_id % 3 = 1 THEN 'MONTH' ELSE 'WEEK' END AS subscribingplanplaninterval,
  CAST(event_id % 50 AS INT) AS currenttimes, CAST(CASE WHEN event_id % 5 = 0 THEN -1 ELSE 12 END AS INT) AS maxtimes
FROM (SELECT 'v2-' AS tag, * FROM {{events}}
      UNION ALL SELECT 'v2r-' AS tag, * FROM {{events}} WHERE event_type = 'signup')""",
        "custom_eventlog": f"""
SELECT 'c-' || {_s('event_id')} AS id, 'w' || {_s('user_id')} AS workspaceid,
  ts + INTERVAL '6' HOUR AS logdatetimestamp, {d.epoch("ts + INTERVAL '6' HOUR")} AS logtimestamp,
  CASE WHEN value < 60 THEN 'MEMO_ADDED' WHEN value < 90 THEN 'PLAN_MIGRATION_2022_01'
    WHEN value < 120 THEN 'PLAN_MIGRATION_2022_03' ELSE 'PLAN_MIGRATION_2022_11' END AS eventname,
  CASE WHEN value < 60 THEN 'P' || {_s('event_id % 4')} ELSE 'M' || {_s('event_id % 4')} END AS planid
FROM (SELECT * FROM {{events}} WHERE event_type = 'purchase'
      UNION ALL SELECT * FROM {{events}} WHERE event_type = 'purchase' AND value > 100)""",
        "subscription": f"""
SELECT DISTINCT 's' || {_s('user_id')} AS id, 'w' || {_s('user_id')} AS workspaceid,
  CASE WHEN user_id % 4 = 0 THEN 'CANCELLED' ELSE 'ACTIVE' END AS status FROM {{events}}""",
        "subscription_plan": f"""
SELECT 'P' || {_s('p_partkey')} AS id, {_TITLE.replace('{k}', 'p_partkey')} AS title,
  CAST(p_size % 5 AS INT) AS grade, CAST(floor(p_retailprice) AS BIGINT) AS price, CAST(1 AS INT) AS resetperiodvalue,
  CAST(CASE p_size % 3 WHEN 0 THEN 12 WHEN 1 THEN 1 ELSE 6 END AS INT) AS suppliedresetcount,
  CAST(p_size % 2 AS INT) AS planversion FROM {{part}}""",
        "subscription_plan_category": f"""
SELECT 'P' || {_s('p_partkey')} AS planid, 'planCategoryDepth1' AS type,
  CASE WHEN p_size = 50 THEN 'd1-Test' ELSE 'd1-' || p_type END AS plancategoryvalueid FROM {{part}}
UNION ALL SELECT 'P' || {_s('p_partkey')}, 'planCategoryDepth2', 'd2-' || p_brand FROM {{part}}
UNION ALL SELECT 'P' || {_s('p_partkey')}, 'planCategoryDepth3', 'd3-' || {_s('p_size')} FROM {{part}} WHERE p_size < 25
UNION ALL SELECT 'P' || {_s('p_partkey')}, 'planCategoryDepth5',
  CASE WHEN p_size % 20 = 0 THEN 'd5-Free' ELSE 'd5-Paid' END FROM {{part}}""",
        "subscription_plan_category_value": f"""
SELECT DISTINCT 'd1-' || p_type AS id, CASE WHEN p_type = 'PROMO' THEN 'Government Support' ELSE p_type END AS name FROM {{part}}
UNION ALL SELECT DISTINCT 'd1-Test', 'Test' FROM {{part}}
UNION ALL SELECT DISTINCT 'd2-' || p_brand, CASE p_brand WHEN 'Brand#13' THEN 'Trial Plan' WHEN 'Brand#14' THEN 'Demo Plan'
  ELSE p_brand END FROM {{part}} WHERE p_brand <> 'Brand#25'
UNION ALL SELECT DISTINCT 'd3-' || {_s('p_size')}, 'Tier ' || {_s('p_size')} FROM {{part}}
UNION ALL SELECT DISTINCT CASE WHEN p_size % 20 = 0 THEN 'd5-Free' ELSE 'd5-Paid' END,
  CASE WHEN p_size % 20 = 0 THEN 'Free' ELSE 'Paid' END FROM {{part}}""",
        "invoice_category": f"""
SELECT 'i' || {_s('o_orderkey')} AS invoiceid, 's' || o_orderstatus AS invoicecategoryvalueid FROM {{orders}}
UNION ALL SELECT 'i' || {_s('o_orderkey')}, 'p' || o_orderpriority FROM {{orders}}
UNION ALL SELECT 'i' || {_s('o_orderkey')}, 'n' || {_s('c_nationkey')}
  FROM {{orders}} JOIN {{customer}} ON c_custkey = o_custkey WHERE c_acctbal > 0""",
        "invoice_category_value": f"""
SELECT DISTINCT 's' || o_orderstatus AS value, '1' AS level, 'STATUS_' || o_orderstatus AS labelcode FROM {{orders}}
UNION ALL SELECT DISTINCT 'p' || o_orderpriority, '2', 'PRIORITY_' || o_orderpriority FROM {{orders}}
UNION ALL SELECT DISTINCT 'n' || {_s('n_nationkey')}, '3', n_name FROM {{nation}}""",
        "payment_invoice": f"""
SELECT 'i' || {_s('o_orderkey')} AS id, CASE o_orderstatus WHEN 'F' THEN 'REGULAR' WHEN 'O' THEN 'UPGRADE' ELSE 'ONETIME' END AS type,
  'w' || {_s('o_custkey')} AS workspaceid, CAST(o_totalprice AS DECIMAL(19,8)) AS amount,
  CAST(CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE CAST(o_totalprice AS DECIMAL(18,8))
    + CAST(o_orderkey % 100 AS DECIMAL(3,0)) * CAST(0.00000001 AS DECIMAL(8,8)) END AS DECIMAL(19,8)) AS finalamount,
  {invoice_time} AS createdat FROM {{orders}}""",
        "payment_service": f"""
SELECT 'pay' || {_s('o_orderkey')} AS id, 'i' || {_s('o_orderkey')} AS invoiceid,
  CASE WHEN o_orderkey % 17 = 0 THEN 'FAILED' ELSE 'PAID' END AS status, o_orderpriority AS type,
  {invoice_time} + INTERVAL '5' SECOND AS createdat FROM {{orders}}
UNION ALL SELECT 'retry' || {_s('o_orderkey')}, 'i' || {_s('o_orderkey')},
  CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice > 400000 THEN 'PAID' ELSE 'FAILED' END, o_orderpriority,
  {invoice_time} + INTERVAL '65' SECOND FROM {{orders}} WHERE o_orderstatus = 'P'""",
        "payment_invoice_item": f"""
SELECT {item} AS id, 'i' || {_s('l_orderkey')} AS invoiceid,
  CASE WHEN l_linenumber % 3 = 0 THEN 'EXTRACHARGE' ELSE 'PLAN' END AS type,
  CASE WHEN l_linestatus = 'O' THEN 'PURCHASE' ELSE 'REFUND' END AS transactiontype,
  CASE WHEN l_linenumber % 3 = 0 THEN 'Extra documents' ELSE {_TITLE.replace('{k}', 'l_partkey')} END AS title,
  CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE 'P' || {_s('l_partkey')} END AS planid,
  l_shipdate + {_SHIFT} AS periodstart, l_shipdate + {_SHIFT} + INTERVAL '30' DAY AS periodend,
  CASE WHEN l_returnflag = 'N' THEN 'CHARGE' END AS featureusageaction,
  CASE WHEN l_returnflag = 'A' THEN 'ADD' END AS pluginaction FROM {{lineitem}}""",
        "payment_refund_info": f"""
SELECT 'pay' || {_s('l_orderkey')} AS paymentid, {refund_time} AS refundedat,
  CAST(l_extendedprice AS DECIMAL(19,2)) AS amount FROM {{lineitem}} WHERE l_returnflag = 'R' AND l_linenumber = 7""",
        "payment_history": f"""
SELECT 'ph' || {_s('o_orderkey')} AS id, 'pay' || {_s('o_orderkey')} AS paymentid, 'PAID' AS paymentstatus,
  {invoice_time} + (5 + o_orderkey % 91) * INTERVAL '1' SECOND AS timestamp FROM {{orders}}
UNION ALL SELECT 'ph2-' || {_s('o_orderkey')}, 'pay' || {_s('o_orderkey')}, 'PAID',
  {invoice_time} + (2 + o_orderkey % 9) * INTERVAL '1' SECOND FROM {{orders}} WHERE o_orderstatus = 'P'
UNION ALL SELECT 'phr-' || {item}, 'pay' || {_s('l_orderkey')}, 'REFUNDED',
  {refund_time} + (l_suppkey % 10) * INTERVAL '1' SECOND FROM {{lineitem}} WHERE l_returnflag = 'R' AND l_linenumber = 7""",
        "test_user": f"""
SELECT 't' || {_s('c_custkey')} AS id, 'u' || {_s('c_custkey')} AS userid FROM {{customer}} WHERE c_acctbal < -700""",
        "member": f"""
SELECT 'u' || {_s('c_custkey')} AS userid, 'w' || {_s('c_custkey')} AS workspaceid FROM {{customer}}""",
        "document_service": f"""
SELECT 'Participant' AS __en, 'Participant#' || {item} AS entity,
  CASE WHEN l_discount = 0.1 AND l_tax = 0 THEN NULL ELSE 'd' || {_s('l_orderkey')} END AS documentid,
  {contact} AS contact, {role} AS type, CASE WHEN l_linestatus = 'F' THEN 'MOBILE' ELSE 'DESKTOP' END AS signingmethod,
  CASE WHEN l_suppkey % 2 = 0 THEN 'ko' ELSE 'en' END AS locale,
  {d.ts_text("l_shipdate + INTERVAL '14' DAY")} AS due,
  CASE WHEN l_returnflag = 'A' THEN NULL ELSE {d.ts_text("l_shipdate + (l_partkey % 3600) * INTERVAL '1' SECOND")} END AS viewed,
  {_s('l_suppkey * 60')} AS signingduration, l_shipdate AS createdat, {d.day_text('l_shipdate')} AS createddate FROM {{lineitem}}
UNION ALL SELECT 'Document', 'Document#' || {_s('o_orderkey')}, 'd' || {_s('o_orderkey')}, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  o_orderdate, {d.day_text('o_orderdate')} FROM {{orders}}""",
        "participant_data": f"""
SELECT 'd' || {_s('l_orderkey')} AS documentid,
  {item} || CASE WHEN l_returnflag = 'N' AND l_linenumber = 4 THEN '-old' ELSE '' END AS participantid,
  CASE WHEN l_quantity = 50 THEN NULL WHEN l_partkey % 2 = 0 THEN {d.sha("'user' || " + _s('l_partkey'))} || '@mail.com'
    ELSE {d.sha("'+82100000' || " + _s('l_partkey'))} END AS contact,
  {role} AS type, CAST(l_linenumber AS BIGINT) AS ordinal,
  CASE WHEN l_quantity = 50 OR l_partkey % 2 = 1 THEN 'kakao' ELSE 'email' END AS contactinfo,
  CASE WHEN l_linestatus = 'F' THEN 'MOBILE' ELSE 'DESKTOP' END AS signingmethod,
  CASE WHEN l_suppkey % 2 = 0 THEN 'ko' ELSE 'en' END AS locale, l_shipdate + INTERVAL '14' DAY AS due,
  CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_shipdate + (l_partkey % 3600) * INTERVAL '1' SECOND END AS viewed,
  CAST(l_suppkey * 60 AS BIGINT) AS signingduration, l_shipdate + INTERVAL '9' HOUR AS createdat
FROM {{lineitem}} WHERE l_returnflag <> 'R'""",
        "document_creation": f"""
SELECT 'd' || {_s('o_orderkey')} AS id, 'u' || {_s('o_custkey')} AS userid, 'w' || {_s('o_custkey')} AS workspaceid,
  'w' || {_s('o_custkey % 100')} AS estimated_workspaceid, o_orderdate AS createdat,
  CAST(o_orderkey % 8 AS BIGINT) AS currentsigningorder FROM {{orders}}""",
        "user_service": f"""
SELECT 'u' || {_s('c_custkey')} AS id, CASE WHEN c_nationkey < 12 THEN 'GOOGLE' ELSE 'EMAIL' END AS idprovidertype,
  {d.sha("'user' || " + _s('c_custkey'))} || '@mail.com' AS profileemail, c_name AS profilename,
  c_mktsegment AS profilesurveycompanycategory, {d.sha("'+82100000' || " + _s('c_custkey + 1'))} AS profilesurveyphonenumber,
  CASE WHEN c_acctbal > 9000 THEN NULL ELSE TIMESTAMP '1996-01-01 00:00:00' + c_custkey * INTERVAL '1' DAY END AS activatedat,
  TIMESTAMP '1995-06-01 00:00:00' + c_custkey * INTERVAL '1' DAY AS createdat FROM {{customer}}""",
        "viral_effect_analysis": f"""
SELECT CASE WHEN c_acctbal < 0 THEN NULL ELSE 'u' || {_s('c_custkey')} END AS id, c_name AS profilename
FROM {{customer}} WHERE c_mktsegment = 'BUILDING'""",
        "document": f"""
SELECT 'd' || {_s('o_orderkey')} AS id, 'u' || {_s('o_custkey')} AS userid, 'w' || {_s('o_custkey')} AS workspaceid,
  'w' || {_s('o_custkey % 100')} AS estimated_workspaceid, o_orderdate AS createdat FROM {{orders}}""",
        "service": f"""
SELECT 'd' || {_s('o_orderkey')} AS id, p_name AS title FROM {{orders}} JOIN {{part}} ON p_partkey = o_custkey WHERE p_size < 45""",
        "document_category": f"""
SELECT 'd' || {_s('o_orderkey')} AS documentid FROM {{orders}} WHERE o_orderstatus = 'F'""",
        "document_form_category": f"""
SELECT 'd' || {_s('o_orderkey')} AS documentid FROM {{orders}} WHERE o_orderstatus = 'O'""",
        "template": f"""
SELECT 't' || {_s('p_partkey')} AS id, 'w' || {_s('p_partkey')} AS workspaceid, 'm' || {_s('p_partkey')} AS memberid,
  p_name AS title, TIMESTAMP '2024-01-01 00:00:00' + p_size * INTERVAL '1' DAY AS createdat FROM {{part}}""",
        "template_category": f"""
SELECT 't' || {_s('p_partkey')} AS templateid FROM {{part}} WHERE p_brand = 'Brand#7'""",
        "template_form_category": f"""
SELECT 't' || {_s('p_partkey')} AS templateid FROM {{part}} WHERE p_brand = 'Brand#9'""",
    }


def duck_views(renewed: str = "SUBSCRIPTION_RENEWED", reset: str = "SUBSCRIPTION_RESET") -> dict[str, str]:
    names = {name: name for name in RAW}
    return {k: v.format(**names).strip() for k, v in views(DuckDialect, renewed, reset).items()}


class Tables:
    """Business tables of one data directory as DataFrames, by attribute."""

    def __init__(self, spark: SparkSession, directory: str, renewed="SUBSCRIPTION_RENEWED", reset="SUBSCRIPTION_RESET"):
        # Wall-clock times are compared as they are written.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.directory = directory
        self._sql = views(SparkDialect, renewed, reset)
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = read_table(self.spark, self.directory, name)
        return self._raw[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._sql:
            raise AttributeError(name)
        sql = self._sql[name].replace("TIMESTAMP '", "TIMESTAMP_NTZ '")
        used = {raw: self.raw(raw) for raw in RAW if f"{{{raw}}}" in sql}
        return self.spark.sql(sql, **used)
