"""The daily jobs end to end: raw tables in, result tables out.

``t`` is anything with one DataFrame per business table as attribute. What
several steps read is staged once in the shared folder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.hot import SLICE, hot_keys, only, without
from ledgerline.plans import billing, events, periods, referral, titles
from ledgerline.plans.events import SUBSCRIPTION, Labels
from ledgerline.sources.tables import COMPACT, append_new, append_rows, delete_where, replace_table, stage
from ledgerline.sources.versions import Versions


@dataclass(frozen=True)
class Groups:
    """Staged plan runs, and the workspaces that are too big for one task."""

    rows: DataFrame
    hot: list


def hot_workspaces(t, hot_rows: int | None = None) -> list:
    return events.hot_workspaces(
        t.subscription_event_log, t.subscription_event_log_v2, t.custom_eventlog, t.subscription, hot_rows
    )


def per_workspace(t, hot: list, step) -> DataFrame:
    """``step(v1, v2, custom, subscription, hot)`` on normal and on hot workspaces."""
    logs = (t.subscription_event_log, t.subscription_event_log_v2, t.custom_eventlog, t.subscription)
    if not hot:
        return step(*logs, [])
    v1, v2, custom, subscription = logs
    normal, heavy = [
        step(pick(v1, "workspaceid", hot), v2, pick(custom, "workspaceid", hot), pick(subscription, "workspaceid", hot), keys)
        for pick, keys in ((without, []), (only, hot))
    ]
    return normal.unionByName(heavy.drop(SLICE))


def gathered(t, step, labels: Labels = SUBSCRIPTION, hot_rows: int | None = None) -> tuple[DataFrame, list]:
    """``step(events, slice_by)`` on all events, and the hot workspaces found."""
    hot = hot_workspaces(t, hot_rows)

    def on_events(v1, v2, custom, subscription, keys):
        rows = events.gather(v1, v2, custom, subscription, labels, keys)
        return step(rows, SLICE if keys else None)

    return per_workspace(t, hot, on_events), hot


def event_log(t, labels: Labels = SUBSCRIPTION, hot_rows: int | None = None, keep_plan_of=()) -> DataFrame:
    return gathered(t, lambda rows, cut: events.finish_log(rows, labels, keep_plan_of, cut), labels, hot_rows)[0]


def plan_groups(
    t, labels: Labels = SUBSCRIPTION, hot_rows: int | None = None, keep_plan_of=()
) -> tuple[DataFrame, list]:
    """Events with their plan runs, and the workspaces too big for one task."""

    def step(rows, cut):
        return periods.plan_groups(events.finish_log(rows, labels, keep_plan_of, cut), labels, cut)

    return gathered(t, step, labels, hot_rows)


def staged_groups(t, hot_rows: int | None = None) -> Groups:
    rows, hot = plan_groups(t, SUBSCRIPTION, hot_rows)
    needed = ["workspaceid", "idx", "logtimestamp", "logdatetimestamp", "planid", "group_planid", "group_number", "sourceid"]
    return Groups(stage(rows.select(*needed, *periods.ATTRIBUTES), "plan-groups"), hot)


def plan_attributes(t, how: str = "left") -> DataFrame:
    return periods.plan_attributes(
        t.subscription_plan, t.subscription_plan_category, t.subscription_plan_category_value, how
    )


def subscription_periods(t, groups: Groups | None = None, hot_rows: int | None = None) -> DataFrame:
    groups = groups or staged_groups(t, hot_rows)
    return periods.subscription_periods(groups.rows, plan_attributes(t), t.subscription, groups.hot)


def invoice_base(t, leave_out=()) -> DataFrame:
    return billing.invoice_base(
        t.payment_invoice,
        t.payment_service,
        t.payment_invoice_item,
        t.payment_refund_info,
        billing.excluded_workspaces(t.test_user, t.member),
        billing.excluded_plans(plan_attributes(t, "inner")),
        leave_out,
    )


def invoice_adjusted(
    t, as_of: Column, leave_out=(), hot_rows: int | None = None, runs: DataFrame | None = None
) -> tuple[DataFrame, list]:
    """Adjusted invoices, and the workspaces with too many rows for one task.

    ``runs`` are the subscription periods, if they are stored already.
    """
    if runs is None:
        runs = stage(subscription_periods(t, hot_rows=hot_rows), "periods")
    base = stage(invoice_base(t, leave_out), "invoice-base")
    both = base.select(F.coalesce("workspaceid", F.lit(billing.NO_WORKSPACE)).alias("workspaceid"))
    hot = hot_keys(both.union(runs.select("workspaceid")), "workspaceid", hot_rows)
    return billing.invoice_adjusted(base, plan_attributes(t, "inner"), runs, as_of, hot), hot


def billing_rawdata(
    t,
    as_of: Column,
    leave_out=(),
    keep_unmatched: bool = False,
    hot_rows: int | None = None,
    runs: DataFrame | None = None,
) -> DataFrame:
    adjusted, hot = invoice_adjusted(t, as_of, leave_out, hot_rows, runs)
    ledger = billing.billing_ledger(stage(adjusted, "invoice-adjusted"), t.payment_refund_info)
    matched = billing.billing_matched(billing.billing_calendar(ledger, hot), t.payment_history, keep_unmatched)
    return billing.billing_rawdata(matched)


def staged_participants(t, as_of: Column) -> DataFrame:
    """The last month's participants, read by the deletion and by the insertion."""
    return stage(referral.participants_stage(t.document_service, as_of), "participants-stage", COMPACT)


def referral_attribution(t, as_of: Column) -> tuple[DataFrame, DataFrame]:
    """The refreshed participants and the users newly attributed to a contact."""
    staged = staged_participants(t, as_of)
    stored = referral.participants_refresh(t.participant_data, staged)
    touches = referral.first_touch(stored, t.document_creation)
    return stored, referral.referral_attribution(touches, t.user_service, t.test_user, t.viral_effect_analysis)


def titles_of_documents(t, done: DataFrame) -> DataFrame:
    return titles.new_documents(t.document, t.service, t.test_user, done)


def titles_of_templates(t, done: DataFrame | None = None) -> DataFrame:
    return titles.new_templates(t.template, billing.excluded_workspaces(t.test_user, t.member), done)


def run(t, folder: str, as_of: Column, contracts: DataFrame, forms: DataFrame, hot_rows: int | None = None) -> None:
    """One day's batch: write every result table below ``folder``.

    Documents are classified once per table and appended; all other tables are
    replaced. Contract and form categories each go by their own table, so either
    can be filled in later.
    """
    spark = contracts.sparkSession
    replace_table(subscription_periods(t, hot_rows=hot_rows), f"{folder}/subscription_periods")
    runs = spark.read.parquet(f"{folder}/subscription_periods")
    replace_table(billing_rawdata(t, as_of, hot_rows=hot_rows, runs=runs), f"{folder}/payment_billing_rawdata")

    participants, found = referral_attribution(t, as_of)
    attributed = delete_where(t.viral_effect_analysis, F.col("id").isNull())
    attributed = stage(attributed.unionByName(found, allowMissingColumns=True), "viral-effect")
    replace_table(referral.participants_table(participants), f"{folder}/participant_data")
    replace_table(referral.attribution_table(attributed), f"{folder}/viral_effect_analysis")

    contract = titles_of_documents(t, t.document_category)
    form = titles_of_documents(t, t.document_form_category)
    templates = titles_of_templates(t)
    append_new_rows(titles.contract_categories(contract, contracts, "documentid"), f"{folder}/document_category")
    append_new_rows(titles.form_categories(form, forms, "documentid"), f"{folder}/document_form_category")
    replace_table(titles.contract_categories(templates, contracts, "templateid"), f"{folder}/template_category")
    replace_table(titles.form_categories(templates, forms, "templateid"), f"{folder}/template_form_category")


def run_versioned(t, folder: str, version: str, as_of: Column, contracts: DataFrame, forms: DataFrame, hot_rows: int | None = None) -> None:
    """One day's batch as a version of all result tables together (see ``sources.versions``).

    The version counts once its last table is written; a run that stops before
    leaves the version before it whole, and can be repeated under its name.
    Appended tables hold the new rows of the day only; ``Versions.all_rows``
    reads them over all versions.
    """
    versions = Versions(contracts.sparkSession, folder)
    with versions.writing(version) as path:
        run(t, path, as_of, contracts, forms, hot_rows)


def append_new_rows(rows: DataFrame, path: str) -> None:
    """Append the documents that the table at ``path`` does not hold yet.

    The table is looked at when it is written, so a run that stopped half-way
    can be repeated.
    """
    try:
        held = rows.sparkSession.read.schema("documentid string").parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        append_rows(rows, path)
        return
    append_rows(stage(append_new(rows, held, "documentid"), "titles"), path)
