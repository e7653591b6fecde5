"""Streams of the incremental steps: two micro-batches and a replayed one give the batch result."""

import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgerline.plans import daily, referral, titles
from ledgerline.sources.buckets import Buckets
from ledgerline.sources.tables import stage
from ledgerline.sources.versions import Versions
from ledgerline.streaming import incremental
from testbed.oracle import BATCH
from testbed.queries import dictionary


def at(text):
    return F.lit(text).cast("timestamp_ntz")


def drain(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination(300)
    assert query.exception() is None


def forget_last_commit(checkpoint):
    commits = f"{checkpoint}/commits"
    last = max(int(name) for name in os.listdir(commits) if name.isdigit())
    os.unlink(f"{commits}/{last}")
    crc = f"{commits}/.{last}.crc"
    if os.path.exists(crc):
        os.unlink(crc)


def files(folder):
    return {
        os.path.relpath(os.path.join(top, name), folder)
        for top, _, names in os.walk(folder)
        for name in names
        if name.endswith(".parquet")
    }


def test_titles_in_two_batches_and_a_replayed_one(spark, t, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    versions, book = Versions(spark, str(tmp_path / "out")), dictionary(t)
    half = F.pmod(F.xxhash64("id"), F.lit(2))

    def run():
        documents = spark.readStream.schema(t.document.schema).parquet(source)
        drain(incremental.title_batches(documents, lambda: t, book, versions, checkpoint))

    t.document.where(half == 0).coalesce(1).write.mode("append").parquet(source)
    run()
    # The second batch brings rows of the first one again.
    again = t.document.where((half == 1) | (F.pmod(F.xxhash64("id"), F.lit(10)) == 0))
    again.unionByName(again.limit(5)).coalesce(1).write.mode("append").parquet(source)
    run()
    assert len(versions.complete()) == 2
    forget_last_commit(checkpoint)
    run()
    assert len(versions.complete()) == 2
    expected = titles.contract_categories(daily.titles_of_documents(t, t.document_category), book, "documentid")
    assert rows(versions.all_rows("document_category")) == rows(expected)


def test_participants_in_two_batches_and_a_replayed_one(spark, t, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    versions = Versions(spark, str(tmp_path / "out"))
    # Rows of one document come in both batches.
    half = F.pmod(F.xxhash64("entity"), F.lit(2))
    seen = {"rows": t.document_service.where(half == 0)}

    def tables():
        others = {
            name: getattr(t, name)
            for name in ("participant_data", "viral_effect_analysis", "document_creation", "user_service", "test_user")
        }
        return SimpleNamespace(document_service=seen["rows"], **others)

    def run():
        items = spark.readStream.schema(t.document_service.schema).parquet(source)
        drain(incremental.referral_batches(items, tables, lambda: at(BATCH), versions, checkpoint, buckets=8))

    seen["rows"].coalesce(1).write.mode("append").parquet(source)
    run()
    touches = referral.first_touch(incremental.participants(versions, 8).current(), t.document_creation)
    first = stage(referral.referral_attribution(touches, t.user_service, t.test_user, t.viral_effect_analysis), "first")

    t.document_service.where(half == 1).coalesce(1).write.mode("append").parquet(source)
    seen["rows"] = t.document_service
    run()
    assert len(versions.complete()) == 3  # the start and two batches
    before = files(tmp_path / "out")
    forget_last_commit(checkpoint)
    run()
    assert files(tmp_path / "out") == before

    staged = referral.participants_stage(t.document_service, at(BATCH))
    whole = stage(referral.participants_refresh(t.participant_data, staged), "whole")
    stored = incremental.participants(versions, 8).current()
    assert rows(stored) == rows(referral.participants_table(whole))
    known = t.viral_effect_analysis.where("id IS NOT NULL")
    known = known.unionByName(first, allowMissingColumns=True)
    second = referral.referral_attribution(
        referral.first_touch(whole, t.document_creation), t.user_service, t.test_user, known
    )
    expected = referral.attribution_table(known.unionByName(second, allowMissingColumns=True))
    assert rows(versions.all_rows("viral_effect_analysis")) == rows(expected)


def test_buckets_not_touched_keep_their_files(spark, tmp_path):
    versions = Versions(spark, str(tmp_path))
    schema = spark.range(0).selectExpr("id AS k", "id AS v").schema
    table = Buckets(versions, "t", "k", schema, 16)
    assert table.current().count() == 0
    rows_of = spark.range(200).selectExpr("id AS k", "id AS v")
    with versions.writing("a"):
        table.rewrite(rows_of, table.touched(rows_of), "a")
    before = files(tmp_path / "a")
    change = spark.range(2).selectExpr("id AS k")
    touched = table.touched(change)
    assert 1 <= len(touched) <= 2
    hit, rest = table.split(touched)
    assert hit.count() + rest.count() == 200
    with pytest.raises(RuntimeError), versions.writing("b"):
        table.rewrite(hit.limit(0), touched, "b")
        raise RuntimeError("stopped")
    assert rows(table.current()) == rows(rows_of)
    with versions.writing("b"):
        table.rewrite(hit.withColumn("v", F.lit(-1).cast("long")), touched, "b")
    assert files(tmp_path / "a") == before
    assert {int(name.split("=")[1].split("/")[0]) for name in files(tmp_path / "b" / "t")} == set(touched)
    expected = rest.unionByName(hit.withColumn("v", F.lit(-1).cast("long")))
    assert rows(table.current()) == rows(expected)
    # A bucket may become empty.
    with versions.writing("c"):
        table.rewrite(hit.limit(0), touched, "c")
    assert rows(table.current()) == rows(rest)
