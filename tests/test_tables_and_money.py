from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgerline.functions import dates, identity, money
from ledgerline.plans import billing, referral
from ledgerline.plans.periods import one_status
from ledgerline.sources import tables


def test_dimension_is_text_with_lower_names(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    path.write_text("Id,Name\n001,Alpha\n2,\n", encoding="utf-8")
    df = tables.load_dimension(spark, str(path))
    assert df.dtypes == [("id", "string"), ("name", "string")]
    assert rows(df) == [("001", "Alpha"), ("2", None)]


def test_append_and_replace(spark, tmp_path):
    path = str(tmp_path / "table")
    df = spark.createDataFrame([(1,), (2,)], "K int")
    tables.append_rows(df, path)
    tables.append_rows(df, path)
    assert spark.read.parquet(path).count() == 4
    assert spark.read.parquet(path).columns == ["k"]
    tables.replace_table(df.limit(0), path)
    assert spark.read.parquet(path).count() == 0


def test_stage_uses_the_named_folder(spark):
    df = tables.stage(spark.range(3), "three")
    assert df.inputFiles()[0].split("file://")[-1].startswith(spark.conf.get("spark.checkpoint.dir"))
    assert df.count() == 3


def test_scan_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "items")
    data = [("Participant", "a", "2024-01-01"), ("Participant", "b", "2024-03-01"), ("Document", "c", "2024-03-01")]
    spark.createDataFrame(data, "__en string, entity string, createddate string").write.partitionBy("createddate").parquet(path)
    items = spark.read.schema("__en string, entity string, createddate string").parquet(path)
    as_of = F.lit("2024-03-20 20:00:00").cast("timestamp_ntz")
    df = tables.scan_entities(items, "Participant", dates.recent_since(as_of))
    assert [r["entity"] for r in df.collect()] == ["b"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "createddate" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "EqualTo(__en,Participant)" in plan


def test_append_new_takes_null_keys(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert rows(tables.append_new(df, spark.createDataFrame([(1,), (None,)], "k int"), "k")) == [(2,), (None,)]


@pytest.mark.parametrize(
    "title, resets, unit, full",
    [
        ("Starter Plan", 12, 25000, 50000),
        ("Starter Plan", 1, 2083, 50000),
        ("Starter Plan", 6, None, 50000),
        ("Business Plan", 6, 18750, 75000),
        ("Voucher40", 1, 16666, 400000),
        ("Premium", 1, 33000, 33000),
        ("Premium", 12, None, None),
        ("Basic", 1, None, None),
        (None, 1, None, None),
    ],
)
def test_price_book(spark, title, resets, unit, full):
    df = spark.createDataFrame([(title, resets)], "t string, r int")
    assert df.select(money.unit_price(F.col("t"), F.col("r")), money.full_price(F.col("t"), F.col("r"))).first()[:] == (unit, full)


def test_tax_exclusive(spark):
    df = spark.createDataFrame([(Decimal("33000"),), (Decimal("-33000"),), (Decimal("0"),), (Decimal("1"),)], "a decimal(19,2)")
    assert [r[0] for r in df.select(money.tax_exclusive(F.col("a"))).collect()] == [30000, -30000, 0, 1]


def test_masking(spark):
    df = spark.createDataFrame([("me@x.org",), ("01012345678",), (None,)], "c string")
    kind = identity.contact_kind(F.col("c"))
    found = df.select(kind, identity.mask_contact(F.col("c"), kind)).collect()
    assert [r[0] for r in found] == ["email", "kakao", "kakao"]
    assert found[0][1].endswith("@x.org") and len(found[0][1]) == 64 + 6
    phone = spark.sql("SELECT sha2('+821012345678', 256)").first()[0]
    assert found[1][1] == phone and found[2][1] is None


def test_minutes_count_boundaries(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0, 0, 59), datetime(2024, 1, 1, 0, 1, 1))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(dates.minutes_apart(F.col("a"), F.col("b"))).first()[0] == 1


VOUCHER = "id string, paymentid string, workspaceid string, createdat timestamp_ntz, purchaseitemid string, title string, planid string, finalamount decimal(19,2)"


def test_vouchers_single_and_series(spark):
    when = lambda day: datetime(2024, 1, day)
    data = [("i1", "p1", "w1", when(1), "x1", "Starter Plan", "P12", Decimal(0))]
    data += [(f"j{n}", f"q{n}", "w2", when(n), f"y{n}", "Starter Plan", "P1", Decimal(0)) for n in (1, 2, 3)]
    data += [("k1", "r1", "w2", when(9), "z1", "Starter Plan", "P1", Decimal(5))]
    plans = spark.createDataFrame(
        [("P12", 12, "Government Support", "Paid"), ("P1", 1, "Government Support", "Paid")],
        "planid string, suppliedresetcount int, depth1_name string, depth5_name string",
    )
    found = billing.voucher_allocation(billing.voucher_positions(spark.createDataFrame(data, VOUCHER), plans))
    got = {r["purchaseitemid"]: r["alter_price"] for r in found.collect()}
    assert got == {"x1": 50000, "y1": 3 * 2083, "y2": None, "y3": None}


def test_first_touch_puts_unseen_last(spark):
    people = spark.createDataFrame(
        [("p1", "d1", "c", "email", "M", None, 1), ("p2", "d1", "c", "email", "M", datetime(2024, 1, 2), 1), ("p0", "d1", "c", "email", "M", datetime(2024, 1, 1), 2)],
        "participantid string, documentid string, contact string, contactinfo string, signingmethod string, viewed timestamp_ntz, ordinal bigint",
    )
    docs = spark.createDataFrame(
        [("d1", "u", "w", "e", datetime(2024, 1, 1), 1)],
        "id string, userid string, workspaceid string, estimated_workspaceid string, createdat timestamp_ntz, currentsigningorder bigint",
    )
    assert [r["participantid"] for r in referral.first_touch(people, docs).collect()] == ["p2"]
    unseen = people.where("participantid = 'p1'")
    assert referral.first_touch(unseen, docs).count() == 1
    assert referral.first_touch(unseen, docs, require_viewed=True).isEmpty()


def test_one_status(spark):
    df = spark.createDataFrame([("s1", "w", "OLD"), ("s2", "w", "ACTIVE")], "id string, workspaceid string, status string")
    assert rows(one_status(df)) == [("ACTIVE", "w")]
