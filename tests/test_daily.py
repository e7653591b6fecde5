import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgerline.plans import daily
from testbed.adapters import AS_OF
from testbed.queries import dictionary


def test_run_writes_every_table(spark, t, tmp_path):
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    folder, book = str(tmp_path), dictionary(t)
    daily.run(t, folder, as_of, book, book)

    def table(name):
        return spark.read.parquet(f"{folder}/{name}")

    assert rows(table("payment_billing_rawdata")) == rows(daily.billing_rawdata(t, as_of))
    assert table("subscription_periods").count() > 0
    assert table("participant_data").count() > 0
    assert table("viral_effect_analysis").where("id IS NULL").isEmpty()
    assert table("document_category").columns[-3:] == ["nouns", "category1", "category2"]
    fresh = daily.titles_of_documents(t, t.document_form_category)
    assert table("document_form_category").count() == fresh.count() != table("document_category").count()
    # Replacing takes all templates, not only new ones.
    assert table("template_category").count() == daily.titles_of_templates(t).count()
    assert table("template_category").count() > daily.titles_of_templates(t, t.template_category).count()


def test_a_run_that_stopped_between_the_appends_can_be_repeated(spark, t, tmp_path, monkeypatch):
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    folder, book = str(tmp_path), dictionary(t)
    write = daily.append_new_rows

    def stop(rows, path):
        if path.endswith("form_category"):
            raise RuntimeError("lost")
        write(rows, path)

    with monkeypatch.context() as patched:
        patched.setattr(daily, "append_new_rows", stop)
        with pytest.raises(RuntimeError):
            daily.run(t, folder, as_of, book, book)
    daily.run(t, folder, as_of, book, book)
    for name, done in (("document_category", t.document_category), ("document_form_category", t.document_form_category)):
        ids = [r.documentid for r in spark.read.parquet(f"{folder}/{name}").collect()]
        assert sorted(ids) == sorted(r.documentid for r in daily.titles_of_documents(t, done).collect())
