"""Billing ledger: invoices, vouchers, refunds, calendar flags, payment history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.dates import epoch_seconds, local_time, month_start, quarter_start, year_start
from ledgerline.functions.money import full_price, tax_exclusive, unit_price
from ledgerline.operators.hot import SLICE, apart, cut_slices, only, without
from ledgerline.operators.intervals import interval_join
from ledgerline.operators.matching import first_per, nearby_history, sole_rows
from ledgerline.operators.running import LatestOfAll, Previous, SumSoFar, TotalOfAll, running
from ledgerline.plans.periods import pivot_levels
from ledgerline.sources.tables import conform

# Category names that decide, and level columns of invoices.
TRIAL, DEMO, FREE, TEST = "Trial Plan", "Demo Plan", "Free", "Test"
VOUCHER_CATEGORY = "Government Support"
INVOICE_LEVELS = {"1": "depth1_name", "2": "depth2_name", "3": "depth3_name"}
NO_WORKSPACE = "sample"


def invoice_levels(category: DataFrame, category_value: DataFrame) -> DataFrame:
    values = category_value.withColumnRenamed("value", "invoicecategoryvalueid")
    return pivot_levels(
        category.join(values, "invoicecategoryvalueid"), "invoiceid", "level", "labelcode", INVOICE_LEVELS
    )


def excluded_plans(plan_types: DataFrame) -> DataFrame:
    """Trial, demo, test and free plans."""
    hit = (
        F.col("depth2_name").isin(TRIAL, DEMO) | (F.col("depth5_name") == FREE) | (F.col("depth1_name") == TEST)
    )
    return plan_types.where(hit).select("planid").distinct()


def excluded_workspaces(test_user: DataFrame, member: DataFrame) -> DataFrame:
    return member.join(test_user.select("userid"), "userid").select("workspaceid").distinct()


def first_items(items: DataFrame) -> DataFrame:
    """The purchased item that stands for its invoice: a plan before anything else."""
    plan_first = F.when(F.col("type") == "PLAN", 1).otherwise(2)
    return first_per(items.where("transactiontype = 'PURCHASE'"), ["invoiceid"], [plan_first, F.asc_nulls_last("id")])


def refund_totals(refunds: DataFrame) -> DataFrame:
    return refunds.groupBy("paymentid").agg(
        F.min("refundedat").alias("refundedat"), F.sum("amount").alias("refundedamount")
    )


def invoice_base(
    invoice: DataFrame,
    payment: DataFrame,
    items: DataFrame,
    refunds: DataFrame,
    test_workspaces: DataFrame,
    test_plans: DataFrame,
    leave_out: Sequence[str] = (),
) -> DataFrame:
    """One row per invoice and payment that did not fail, with its first item."""
    inv = invoice.select(
        "id", F.col("type").alias("invoicetype"), "workspaceid", "amount", "finalamount", F.col("createdat").alias("invoicecreatedat")
    )
    if leave_out:
        inv = inv.where(~F.col("id").isin(*leave_out))
    pay = payment.where("status != 'FAILED'").select(
        F.col("invoiceid").alias("id"), F.col("id").alias("paymentid"), "type", "createdat"
    )
    item = first_items(items).select(
        F.col("invoiceid").alias("id"),
        F.col("id").alias("purchaseitemid"),
        "title",
        "planid",
        "periodstart",
        "periodend",
        "featureusageaction",
        "pluginaction",
    )
    rows = (
        inv.join(test_workspaces, "workspaceid", "left_anti")
        .join(pay, "id")
        .join(item.join(test_plans, "planid", "left_anti"), "id")
        .join(refund_totals(refunds).withColumn("_refunded", F.lit(True)), "paymentid", "left")
    )
    return rows.select(
        "id",
        "paymentid",
        F.when(F.col("planid").isNotNull(), "PLAN").otherwise("EXTRACHARGE").alias("purchaseitemcategory"),
        F.when(F.col("_refunded"), "REFUNDED").otherwise("PAID").alias("status"),
        "invoicetype",
        "workspaceid",
        "amount",
        "finalamount",
        "type",
        "periodstart",
        "periodend",
        "invoicecreatedat",
        "createdat",
        "purchaseitemid",
        "title",
        "planid",
        "featureusageaction",
        "pluginaction",
        "refundedat",
        "refundedamount",
    )


def with_voucher_plan(base: DataFrame, plan_types: DataFrame) -> DataFrame:
    """Mark zero-amount invoices of a paid voucher plan; add the plan's resets."""
    voucher = (F.col("depth1_name") == VOUCHER_CATEGORY) & (F.col("depth5_name") != FREE)
    plans = plan_types.where(voucher).select("planid", F.col("suppliedresetcount").alias("_resets"), F.lit(True).alias("_plan"))
    rows = base.join(plans, "planid", "left")
    return rows.withColumn("is_voucher", F.coalesce(F.col("_plan") & (F.col("finalamount") == 0), F.lit(False))).drop("_plan")


VOUCHER_ORDER = ["createdat", "purchaseitemid", "paymentid"]


def number_vouchers(rows: DataFrame, slice_by: str | None = None) -> DataFrame:
    """Positions of a voucher among those of its workspace and title, and prices."""
    one = F.lit(1).cast("bigint")
    order = [F.asc_nulls_last(c) for c in VOUCHER_ORDER]
    key = ["workspaceid", "title", "is_voucher"]
    found = running(rows, key, order, {"r_num": SumSoFar(one), "_all": TotalOfAll(one)}, slice_by)
    title, resets = F.col("title"), F.col("_resets")
    return (
        found.withColumn("r_num_inverse", F.col("_all") - F.col("r_num") + 1)
        .withColumn("price", F.when(F.col("is_voucher"), unit_price(title, resets)))
        .withColumn("origin_price", F.when(F.col("is_voucher"), full_price(title, resets)))
        .drop("_all")
    )


def _voucher_slices(rows: DataFrame) -> DataFrame:
    return cut_slices(rows, "workspaceid", [F.asc_nulls_last(c) for c in VOUCHER_ORDER], "voucher-cut")


def voucher_amount() -> Column:
    """The first voucher of a series carries the whole value, the others none."""
    first = F.col("r_num") == 1
    alone = F.col("r_num_inverse") == 1
    return F.when(first & alone, F.col("origin_price")).when(first, F.col("price") * F.col("r_num_inverse"))


def voucher_positions(base: DataFrame, plan_types: DataFrame, hot: Sequence = ()) -> DataFrame:
    found = apart(
        with_voucher_plan(base, plan_types).where("is_voucher"),
        "workspaceid",
        hot,
        number_vouchers,
        lambda rows: number_vouchers(_voucher_slices(rows), SLICE).drop(SLICE),
    )
    return found.select("purchaseitemid", "workspaceid", "r_num", "r_num_inverse", "price", "origin_price")


def voucher_allocation(positions: DataFrame) -> DataFrame:
    return positions.select(
        "purchaseitemid", "workspaceid", "price", "origin_price", voucher_amount().alias("alter_price")
    )


def invoice_adjusted(
    base: DataFrame,
    plan_types: DataFrame,
    periods: DataFrame,
    as_of: Column,
    hot: Sequence = (),
) -> DataFrame:
    """Invoices with voucher amounts, net difference, running plan and start flag.

    ``base`` and ``periods`` should be staged.
    """
    intervals = periods.select(
        "workspaceid",
        F.col("planid").alias("extracharge_planid"),
        "subscription_start",
        "subscription_end",
        F.coalesce("subscription_end", local_time(as_of)).alias("_until"),
    )
    marked = with_voucher_plan(base, plan_types)
    marked = marked.withColumn("is_voucher", F.col("is_voucher") & F.col("workspaceid").isNotNull())
    return apart(
        marked,
        "workspaceid",
        hot,
        lambda rows: _adjust(rows, without(intervals, "workspaceid", hot) if hot else intervals),
        lambda rows: _adjust(rows, only(intervals, "workspaceid", hot), hot),
    )


def _adjust(invoices: DataFrame, intervals: DataFrame, hot: Sequence = ()) -> DataFrame:
    """The steps run on a workspace's rows where they lie after the first shuffle."""
    slice_by = SLICE if hot else None
    rows = interval_join(
        invoices,
        intervals,
        "workspaceid",
        "createdat",
        "subscription_start",
        "_until",
        ["extracharge_planid", "subscription_start", "subscription_end"],
        F.col("purchaseitemcategory") == "EXTRACHARGE",
        hot,
    )
    if hot:
        rows = _voucher_slices(rows)
    rows = number_vouchers(rows, slice_by)
    # An invoice paid twice has its item twice; either row takes the item's amount.
    amount = F.when(F.col("is_voucher"), voucher_amount())
    order = [F.asc_nulls_last("createdat"), F.asc_nulls_last("paymentid")]
    item = ["workspaceid", "purchaseitemid"]
    rows = running(rows.withColumn("_amount", amount), item, order, {"alter_price": LatestOfAll(F.col("_amount"))}, slice_by)
    rows = rows.where(~F.col("is_voucher") | F.col("alter_price").isNotNull())
    money = T.DecimalType(27, 8)
    value = F.col("alter_price").cast(money)
    rows = rows.withColumn("adj_finalamount", F.coalesce(value, F.col("finalamount")).cast(money)).withColumn(
        "adj_refundedamount", (-F.coalesce(value, F.col("refundedamount"))).cast(money)
    )
    net = F.when(F.col("refundedamount").isNull(), F.greatest("adj_finalamount", F.lit(1).cast(money))).otherwise(
        F.col("adj_finalamount") + F.col("adj_refundedamount")
    )
    rows = rows.withColumn("finalamount_diff", net.cast(money))
    order = [
        F.asc_nulls_last("createdat"),
        F.desc_nulls_first("id"),
        F.asc_nulls_last("paymentid"),
        F.asc_nulls_last("subscription_start"),
    ]
    if hot:
        rows = cut_slices(rows.drop(SLICE), "workspaceid", order, "balance-cut")
    rows = running(rows, ["workspaceid"], order, {"_sum": SumSoFar(F.col("finalamount_diff"))}, slice_by)
    return rows.select(
        "purchaseitemcategory",
        "workspaceid",
        F.col("id").alias("invoiceid"),
        "paymentid",
        "purchaseitemid",
        "status",
        "amount",
        "adj_finalamount",
        "adj_refundedamount",
        "finalamount_diff",
        (F.col("_sum") - F.col("finalamount_diff") == 0).alias("subscription_initial_start_point"),
        "type",
        "invoicetype",
        "createdat",
        "invoicecreatedat",
        F.col("periodstart").alias("invoice_subscription_start"),
        F.col("periodend").alias("invoice_subscription_end"),
        "planid",
        "extracharge_planid",
        "featureusageaction",
        "pluginaction",
        "refundedat",
        "subscription_start",
        "subscription_end",
    )


# Columns a ledger row takes over from its invoice as they are.
KEPT = [
    "subscription_initial_start_point",
    "type",
    "invoicetype",
    "planid",
    "extracharge_planid",
    "featureusageaction",
    "pluginaction",
    "invoice_subscription_start",
    "invoice_subscription_end",
    "invoicecreatedat",
    "createdat",
    "refundedat",
    "subscription_start",
    "subscription_end",
]


def billing_ledger(adjusted: DataFrame, refunds: DataFrame) -> DataFrame:
    """A PAID row per invoice and a REFUNDED row per refund, without tax.

    ``adjusted`` is read twice: pass a staged frame.
    """
    each = refunds.select("paymentid", F.col("refundedat").alias("_at"), F.col("amount").alias("_back"))
    paid = adjusted.select("*", F.lit("PAID").alias("_kind"), F.col("createdat").alias("datevalue"), F.lit(None).cast(refunds.schema["amount"].dataType).alias("_back"))
    refunded = adjusted.join(each, "paymentid").select(
        *[adjusted[c] for c in adjusted.columns], F.lit("REFUNDED").alias("_kind"), F.col("_at").alias("datevalue"), "_back"
    )
    rows = paid.unionByName(refunded)
    back = -tax_exclusive(F.col("_back"))
    is_refund = F.col("_kind") == "REFUNDED"
    return rows.select(
        "purchaseitemcategory",
        "workspaceid",
        "invoiceid",
        "paymentid",
        "purchaseitemid",
        F.col("_kind").alias("status"),
        tax_exclusive(F.col("amount")).alias("amount"),
        F.when(is_refund, back).otherwise(tax_exclusive(F.col("adj_finalamount"))).alias("finalamount"),
        F.when(is_refund, back).otherwise(tax_exclusive(F.col("adj_refundedamount"))).alias("refundedamount"),
        tax_exclusive(F.col("finalamount_diff")).alias("finalamount_diff"),
        "datevalue",
        *KEPT,
    )


CALENDAR = {"year": year_start, "quarter": quarter_start, "month": month_start}


def billing_calendar(ledger: DataFrame, hot: Sequence = ()) -> DataFrame:
    """Previous date, "first start in this period" flags and 1/count weights.

    Rows without a workspace count as one workspace. With these weights a plain
    sum over a period counts workspaces once.
    """
    found = apart(
        ledger.withColumn("_ws", F.coalesce("workspaceid", F.lit(NO_WORKSPACE))),
        "_ws",
        hot,
        _calendar,
        lambda rows: _calendar(cut_slices(rows, "_ws", _calendar_order(), "calendar-cut"), SLICE).drop(SLICE),
    )
    return found.drop("_ws")


def _calendar_order() -> list[Column]:
    columns = ["datevalue", "invoiceid", "status", "paymentid", "finalamount", "subscription_start"]
    return [F.asc_nulls_last(c) for c in columns]


def _calendar(rows: DataFrame, slice_by: str | None = None) -> DataFrame:
    """Units are nested, so the windows over them and the one over the workspace share one shuffle and one sort.

    Rows without a date come last in it, as in ``_calendar_order``.
    """
    start = F.col("subscription_initial_start_point").cast("int")
    last = F.lit("9999-12-31").cast("timestamp_ntz")
    rows = rows.withColumns(
        {f"_{unit}": F.coalesce(begin(F.col("datevalue")), last) for unit, begin in CALENDAR.items()}
    )
    nested = [f"_{unit}" for unit in CALENDAR]
    order = [F.asc(name) for name in nested] + _calendar_order()
    # The shortest key comes first: what is shuffled by it need not be shuffled by longer ones.
    rows = running(rows, ["_ws"], order, {"prev_datevalue": Previous(F.col("datevalue"))}, slice_by)
    totals = {"_start": TotalOfAll(start, "max"), "_rows": TotalOfAll(F.lit(1).cast("bigint"))}
    for depth, unit in enumerate(CALENDAR, 1):
        rows = running(rows, ["_ws", *nested[:depth]], order[depth:], totals, slice_by)
        rows = (
            rows.withColumn(f"new_yn_{unit}", F.col("_start") == 1)
            .withColumn(f"workspace_all_count_{unit}", F.lit(1.0) / F.col("_rows"))
            .drop("_start", "_rows")
        )
    return rows.drop(*nested)


def billing_matched(calendar: DataFrame, history: DataFrame, keep_unmatched: bool = False) -> DataFrame:
    """Ledger rows with the one payment history row they match.

    A history row matched by several ledger rows is ambiguous and drops them
    all. Ledger rows without a match share the empty history id, so they drop
    out likewise unless there is exactly one, or ``keep_unmatched`` is set.
    """
    joined = nearby_history(calendar, history)
    if not keep_unmatched:
        return sole_rows(joined, "paymenthistoryid")
    lost = F.col("paymenthistoryid").isNull()
    return sole_rows(joined.where(~lost), "paymenthistoryid").unionByName(joined.where(lost))


AMOUNT, WEIGHT = T.DecimalType(19, 8), T.DecimalType(19, 10)
_S, _B, _TS = T.StringType(), T.BooleanType(), T.TimestampNTZType()
BILLING_SCHEMA = T.StructType(
    [
        T.StructField(name, kind)
        for name, kind in [
            ("purchaseitemcategory", _S),
            ("workspaceid", _S),
            ("invoiceid", _S),
            ("paymentid", _S),
            ("paymenthistoryid", _S),
            ("purchaseitemid", _S),
            ("status", _S),
            ("amount", AMOUNT),
            ("finalamount", AMOUNT),
            ("refundedamount", AMOUNT),
            ("finalamount_diff", AMOUNT),
            ("subscription_initial_start_point", _B),
            ("type", _S),
            ("invoicetype", _S),
            ("datevalue", _TS),
            ("planid", _S),
            ("extracharge_planid", _S),
            ("featureusageaction", _S),
            ("pluginaction", _S),
            ("invoice_subscription_start", _TS),
            ("invoice_subscription_end", _TS),
            ("invoicecreatedat", _TS),
            ("createdat", _TS),
            ("refundedat", _TS),
            ("subscription_start", _TS),
            ("subscription_end", _TS),
            ("prev_datevalue", _TS),
            ("new_yn_year", _B),
            ("new_yn_quarter", _B),
            ("new_yn_month", _B),
            ("workspace_all_count_year", WEIGHT),
            ("workspace_all_count_quarter", WEIGHT),
            ("workspace_all_count_month", WEIGHT),
        ]
    ]
)


def billing_rawdata(matched: DataFrame) -> DataFrame:
    return conform(matched, BILLING_SCHEMA)
