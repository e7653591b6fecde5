"""Versions come into force whole, and the stored referral tables have the names they have at the border."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgerline.plans import daily, referral
from ledgerline.sources.tables import load_category_map, replace_table
from ledgerline.sources.versions import Versions
from testbed.adapters import AS_OF
from testbed.oracle import BATCH
from testbed.queries import dictionary


def at(text):
    return F.lit(text).cast("timestamp_ntz")


def test_a_stopped_version_leaves_the_old_one_whole(spark, tmp_path):
    versions = Versions(spark, str(tmp_path))
    assert versions.complete() == []
    with pytest.raises(ValueError):
        versions.latest("a")
    with versions.writing("day1") as path:
        for name in "ab":
            replace_table(spark.range(3), f"{path}/{name}")
    with pytest.raises(RuntimeError), versions.writing("day2") as path:
        replace_table(spark.range(5), f"{path}/a")
        raise RuntimeError("stopped between two writes")
    assert versions.complete() == ["day1"]
    assert versions.latest("a").count() == versions.latest("b").count() == 3
    with versions.writing("day2") as path:
        for name in "ab":
            replace_table(spark.range(4), f"{path}/{name}")
    assert versions.complete() == ["day1", "day2"]
    assert versions.latest("a").count() == versions.latest("b").count() == 4
    assert versions.all_rows("a").count() == 7
    with pytest.raises(ValueError), versions.writing("day2"):
        pass


def test_daily_run_that_is_killed_between_two_tables(spark, t, tmp_path, monkeypatch):
    folder, book = str(tmp_path), dictionary(t)
    write, left = daily.replace_table, [3]

    def stop(rows, path):
        if not left[0]:
            raise RuntimeError("lost")
        left[0] -= 1
        write(rows, path)

    with monkeypatch.context() as patched:
        patched.setattr(daily, "replace_table", stop)
        with pytest.raises(RuntimeError):
            daily.run_versioned(t, folder, "day1", at(AS_OF), book, book)
    versions = Versions(spark, folder)
    assert versions.complete() == []
    daily.run_versioned(t, folder, "day1", at(AS_OF), book, book)
    assert versions.complete() == ["day1"]
    stored = versions.latest("participant_data")
    assert stored.columns == [f.name for f in referral.PARTICIPANT_SCHEMA.fields]
    assert {"to", "from", "order"} <= set(stored.columns)
    assert len(versions.latest("viral_effect_analysis").columns) == 30
    ids = [r.documentid for r in versions.all_rows("document_category").collect()]
    assert len(ids) == len(set(ids)) == daily.titles_of_documents(t, t.document_category).count()


def test_names_at_the_border(t):
    source = t.document_service.withColumnsRenamed({"due": "to", "viewed": "from"})
    staged = referral.participants_stage(source, at(BATCH))
    assert rows(staged) == rows(referral.participants_stage(t.document_service, at(BATCH)))
    stored = referral.participants_table(t.participant_data)
    one, other = (referral.participants_refresh(s, staged) for s in (stored, t.participant_data))
    assert rows(one) == rows(other)
    assert rows(referral.first_touch(stored, t.document_creation)) == rows(referral.first_touch(t.participant_data, t.document_creation))


def test_category_map_as_one_object_and_as_lines(spark, tmp_path):
    (tmp_path / "one.json").write_text('{"rent": "Estate",\n "loan": "Finance"}', encoding="utf-8")
    (tmp_path / "lines.json").write_text('{"rent": "Estate"}\n{"loan": "Finance"}\n', encoding="utf-8")
    one = load_category_map(spark, str(tmp_path / "one.json"))
    lines = load_category_map(spark, str(tmp_path / "lines.json"), per_line=True)
    assert rows(one) == rows(lines) == [("Estate", "rent"), ("Finance", "loan")]
