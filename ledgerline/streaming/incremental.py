"""The incremental steps as streams: every micro-batch is one version of its tables.

A micro-batch is written to a folder of its own and comes into force by one row
of the log of versions, under the number that Spark gives it. A batch that Spark
hands over again after a stop finds its version complete and does nothing, so
each counts once. A folder belongs to one stream and one checkpoint: numbers
start anew with a new checkpoint, so that takes a new name or folder.

``tables()`` opens the business tables anew for each batch, since files may have
come since the last one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import DataStreamWriter

from ledgerline.plans import referral, titles
from ledgerline.sources.buckets import BUCKETS, Buckets
from ledgerline.sources.tables import replace_table, scan_entities, stage
from ledgerline.sources.versions import Versions

Step = Callable[[DataFrame, str], None]


def each_once(
    versions: Versions, name: str, step: Step, start: Callable[[], None] | None = None
) -> Callable[[DataFrame, int], None]:
    """``step(batch, version)`` for ``foreachBatch``, skipped for a batch that is complete.

    ``start`` runs before the first version, outside of it, and may write one of its own.
    """

    def run(batch: DataFrame, number: int) -> None:
        version = f"{name}-{number:012d}"
        done = versions.complete()
        if version in done:
            return
        if start is not None and not done:
            start()
        with versions.writing(version):
            step(batch, version)

    return run


def _writer(rows: DataFrame, checkpoint: str, run: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    return rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)


def title_batches(
    documents: DataFrame,
    tables: Callable[[], object],
    contracts: DataFrame,
    versions: Versions,
    checkpoint: str,
    name: str = "documents",
) -> DataStreamWriter:
    """Classify the titles of streamed documents; ``versions.all_rows("document_category")`` has the result.

    Documents that were classified before the stream began, in an earlier batch
    or twice in one are left out; of rows with equal id one is taken.
    """

    def step(batch: DataFrame, version: str) -> None:
        t = tables()
        done = t.document_category.select("documentid")
        if versions.complete():
            done = done.unionByName(versions.all_rows("document_category").select("documentid"))
        fresh = titles.new_documents(batch.dropDuplicates(["id"]), t.service, t.test_user, done)
        found = titles.contract_categories(fresh, contracts, "documentid")
        replace_table(found, f"{versions.path(version)}/document_category")

    return _writer(documents, checkpoint, each_once(versions, name, step))


def participants(versions: Versions, buckets: int = BUCKETS) -> Buckets:
    """The participants that a stream keeps, in buckets of the document."""
    return Buckets(versions, "participant_data", "documentid", referral.PARTICIPANT_SCHEMA, buckets)


def referral_batches(
    items: DataFrame,
    tables: Callable[[], object],
    as_of: Callable[[], Column],
    versions: Versions,
    checkpoint: str,
    name: str = "participants",
    buckets: int = BUCKETS,
) -> DataStreamWriter:
    """Refresh participants and attribute users with every batch of streamed items.

    The stream says which documents changed; their participants are read from
    ``tables().document_service``, so a document whose rows come in several
    batches ends as if they had come together. Only the buckets of these
    documents are written. The stored tables are taken over before the first batch.
    ``participants(versions).current()`` and
    ``versions.all_rows("viral_effect_analysis")`` have the results.
    """
    kept_in = participants(versions, buckets)

    def start() -> None:
        t, version = tables(), f"{name}-start"
        with versions.writing(version):
            stored = stage(referral.participants_table(t.participant_data), "participants-start")
            kept_in.rewrite(stored, kept_in.touched(stored), version)
            known = t.viral_effect_analysis.where("id IS NOT NULL")
            replace_table(referral.attribution_table(known), f"{versions.path(version)}/viral_effect_analysis")

    def step(batch: DataFrame, version: str) -> None:
        t = tables()
        changed = scan_entities(batch, referral.KIND).select("documentid").where("documentid IS NOT NULL").distinct()
        whole = t.document_service.join(stage(changed, "changed-documents"), "documentid", "left_semi")
        staged = stage(referral.participants_stage(whole, as_of()), "participants-stage")

        touched = kept_in.touched(staged)
        hit, rest = kept_in.split(touched)
        kept = referral.participants_delete(hit, staged).select(*referral.STORED)
        known = kept.select("participantid").unionByName(rest.select("participantid"))
        fresh = referral.new_participants(staged, known)
        refreshed = kept_in.rewrite(referral.participants_table(kept.unionByName(fresh)), touched, version)

        touches = referral.first_touch(rest.unionByName(refreshed), t.document_creation)
        attributed = versions.all_rows("viral_effect_analysis")
        found = referral.referral_attribution(touches, t.user_service, t.test_user, attributed)
        replace_table(referral.attribution_table(found), f"{versions.path(version)}/viral_effect_analysis")

    return _writer(items, checkpoint, each_once(versions, name, step, start))
