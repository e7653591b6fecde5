"""Referral steps on large tables run in passes: the same rows, and shuffles of one pass at a time."""

import os
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from conftest import rows
from ledgerline.operators import passes
from ledgerline.plans import referral
from ledgerline.sources.tables import passing, stage, stage_dir

DAY = datetime(2024, 1, 1)
PERSON = (
    "documentid string, participantid string, contact string, type string, ordinal long, contactinfo string, "
    "signingmethod string, locale string, due timestamp_ntz, viewed timestamp_ntz, signingduration long, createdat timestamp_ntz"
)
DOCUMENT = "id string, userid string, workspaceid string, estimated_workspaceid string, createdat timestamp_ntz, currentsigningorder long"


def people(seed, n, null_documents):
    pick, found = random.Random(seed), []
    for i in range(n):
        document = f"d{pick.randrange(12)}"
        document = pick.choice([document, None]) if null_documents and i % 5 == 0 else document
        person = f"p{pick.randrange(n)}" if i % 9 else None
        due = DAY + timedelta(days=pick.randrange(5)) if i % 4 else None
        viewed = DAY + timedelta(seconds=i) if i % 3 else None
        kind = pick.choice(["email", "kakao"])
        contact = pick.choice([None, f"a{i % 7}@x.com"])
        found.append((document, person, contact, "SIGNER", pick.randrange(4), kind, "MOBILE", "ko", due, viewed, i, DAY))
    return found + found[:6]



def left(spark, label):
    return {name for name in os.listdir(stage_dir(spark)) if name.startswith(label)}


def test_refresh_shuffles_nothing_at_its_end(spark):
    """What the caller writes is stored already: no plan with all shuffles in it stays on the disk."""
    stored, staged = (spark.createDataFrame(people(k, 60, k == 1), PERSON) for k in (1, 2))
    found = referral.participants_refresh(stored, staged.drop("ordinal"))
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_refresh_in_passes(spark, monkeypatch):
    stored, staged = (spark.createDataFrame(people(k, 60, k == 1), PERSON) for k in (1, 2))
    staged = stage(staged.drop("ordinal").repartition(3), "test-staged")
    whole = rows(referral.participants_refresh(stored, staged))
    monkeypatch.setattr(passes, "PASS_ROWS", 0)
    before = left(spark, "signing-order"), left(spark, "participants-")
    found = referral.participants_refresh(stored, staged)
    assert rows(found) == whole
    assert left(spark, "signing-order") == before[0]  # what a pass staged on the way is gone
    assert len(left(spark, "participants-") - before[1]) == 2 * passes.PASSES


def test_parts_hold_every_row_once(spark):
    df = spark.createDataFrame([(k,) for k in [None, None, *"abcdefgh", "a"]], "k string")
    parts = [passes.part_of(df, "k", n, 4) for n in range(4)]
    assert sorted(repr(r.k) for p in parts for r in p.collect()) == sorted(repr(r.k) for r in df.collect())


def test_only_what_is_staged_inside_goes(spark):
    outer = stage(spark.range(3), "test-outer")
    with passing(spark):
        inner = stage(spark.range(4), "test-inner")
        assert inner.count() == 4
    assert outer.count() == 3
    assert left(spark, "test-outer") and not left(spark, "test-inner")


def test_touches_in_passes(spark, monkeypatch):
    documents = [(f"d{i % 10}" if i < 12 else None, f"u{i}", "w", "w", DAY, i % 4) for i in range(10)]
    seen = spark.createDataFrame(people(3, 90, True), PERSON).withColumn("viewed", F.col("createdat") + F.expr("make_interval(0, 0, 0, 0, 0, signingduration)"))
    docs = spark.createDataFrame(documents, DOCUMENT)
    seen = seen.dropDuplicates(["participantid", "viewed"])
    whole = rows(referral.first_touch(seen, docs))
    monkeypatch.setattr(passes, "PASS_ROWS", 0)
    found = referral.first_touch(seen, docs)
    assert rows(found) == whole and len(whole) > 5
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
