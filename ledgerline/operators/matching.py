"""Joins and filters that need more than a join type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.functions.dates import epoch_seconds, minutes_apart, seconds_apart


def first_per(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key. Spark keeps one row per key before the shuffle, too."""
    w = W.partitionBy(*key).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def not_in(df: DataFrame, column: str, listed: DataFrame, listed_column: str | None = None) -> DataFrame:
    """``column NOT IN (listed)`` with SQL's NULL rules, as a shuffled anti join.

    A NULL in the list lets nothing pass; a NULL value passes only an empty list.
    """
    items = listed.select(F.col(listed_column or column).alias(column))
    size = items.agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col(column).isNull(), 1)).alias("nulls")
    )
    total = size.select("n").scalar()
    nulls = size.select("nulls").scalar()
    passes = (total == 0) | ((nulls == 0) & F.col(column).isNotNull())
    return df.join(items, column, "left_anti").where(passes)


def sole_rows(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs once; all NULL keys count as one key."""
    alone = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*df.columns)).alias("_row"))
    return alone.where("_n = 1").select("_row.*")


def nearby_history(
    ledger: DataFrame,
    history: DataFrame,
    near_seconds: int = 5,
    near_minutes: int = 1,
) -> DataFrame:
    """Left join ledger rows to payment history by payment, status and closeness.

    A history row matches within ``near_seconds`` whole seconds. The only
    history row of a payment also matches within ``near_minutes`` minute
    boundaries. Payments with several rows are joined by time bucket, so that a
    payment with very many rows does not pair them all.
    """
    counts = history.groupBy("paymentid").agg(F.count(F.lit(1)).alias("_rows"))
    width = F.lit(max(near_seconds, 1))

    def bucket(ts: str) -> Column:
        return F.floor(epoch_seconds(F.col(ts)) / width)

    only = F.coalesce(F.col("_rows") == 1, F.lit(False))
    none = F.lit(-1).cast("bigint")
    right = history.join(counts, "paymentid").select(
        F.col("id").alias("paymenthistoryid"),
        "paymentid",
        F.col("paymentstatus").alias("status"),
        F.col("timestamp").alias("_at"),
        only.alias("_only"),
        F.explode(
            F.when(only, F.array(none)).otherwise(
                F.array(bucket("timestamp") - 1, bucket("timestamp"), bucket("timestamp") + 1)
            )
        ).alias("_bucket"),
    )
    left = ledger.join(counts, "paymentid", "left").withColumn(
        "_bucket", F.when(only, none).otherwise(bucket("datevalue"))
    )
    seconds = seconds_apart(left["datevalue"], right["_at"]) <= near_seconds
    minutes = right["_only"] & (minutes_apart(left["datevalue"], right["_at"]) <= near_minutes)
    same = (
        (left["paymentid"] == right["paymentid"])
        & (left["status"] == right["status"])
        & (left["_bucket"] == right["_bucket"])
    )
    joined = left.join(right, same & (seconds | minutes), "left")
    return joined.select(*[left[c] for c in ledger.columns], right["paymenthistoryid"])
