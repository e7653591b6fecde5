"""Finding heavy keys and spreading them over many tasks.

A key is *hot* when it holds more rows than an even part of the table, the total
divided by the number of shuffle partitions. So there are fewer hot keys than
partitions, whatever the data, and none is left off. NULL is a key like any other.

Rows of hot keys are cut by range over (key, order) into stored slices, as the
rows of a sort are. A key with a third of all rows in one second spreads over a
third of the slices, if the order tells its rows apart.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.sources.tables import stage

SLICE = "_slice"


def parts_of(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def count_rows(df: DataFrame, key: str) -> DataFrame:
    """Rows per key (NULL included), named ``key`` and ``n``; combines before the shuffle."""
    return df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))


def heaviest(counts: DataFrame, rows: int | None = None) -> list:
    """Keys with more than ``rows`` rows out of partial counts (key, n), the largest first.

    Without ``rows`` an even part of the table is the limit, so the list is
    shorter than the number of partitions.
    """
    totals = counts.groupBy("key").agg(F.sum("n").alias("n"))
    limit = F.lit(rows) if rows is not None else totals.agg(F.sum("n") / parts_of(counts)).scalar()
    top = totals.where(F.col("n") > F.coalesce(limit, F.lit(0))).orderBy(F.desc("n"), "key")
    return [row["key"] for row in top.collect()]


def hot_keys(df: DataFrame, key: str, rows: int | None = None) -> list:
    return heaviest(count_rows(df, key), rows)


def among(key: str | Column, hot: Sequence) -> Column:
    """Whether a key is one of the listed ones; never NULL."""
    key = F.col(key) if isinstance(key, str) else key
    named = F.coalesce(key.isin([k for k in hot if k is not None]), F.lit(False))
    return named | key.isNull() if None in hot else named


def time_slice(key: str, seconds: Column, hot: Sequence, grain: int) -> Column:
    """Slice number by time of a row of a hot key, NULL for every other key."""
    if not hot:
        return F.lit(None).cast("bigint")
    return F.when(among(key, hot), F.floor(seconds / grain))


def cut_slices(rows: DataFrame, key: str, order: Sequence[Column], label: str) -> DataFrame:
    """Rows of hot keys, stored, with the number of their range over (key, order) in ``SLICE``.

    Slices of a key are consecutive runs of its rows in that order; rows equal
    in it share a slice. Windows then run per (key, slice) and ``running`` joins
    the runs up.
    """
    ranged = rows.repartitionByRange(parts_of(rows), F.asc_nulls_first(key), *order)
    return stage(ranged.withColumn(SLICE, F.spark_partition_id()), label)


def only(df: DataFrame, key: str, hot: Sequence) -> DataFrame:
    return df.where(among(key, hot))


def without(df: DataFrame, key: str, hot: Sequence) -> DataFrame:
    return df.where(~among(key, hot))


def apart(
    df: DataFrame,
    key: str,
    hot: Sequence,
    whole: Callable[[DataFrame], DataFrame],
    sliced: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Run ``sliced`` on the rows of hot keys and ``whole`` on all others.

    For steps that treat each key by itself, so that the few hot keys do not
    slow down the plan of the rest.
    """
    if not hot:
        return whole(df)
    return whole(without(df, key, hot)).unionByName(sliced(only(df, key, hot)))


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: str,
    how: str = "left",
    hot: Sequence = (),
    salts: int | None = None,
) -> DataFrame:
    """Join a fact to a dimension with one row per key, salting hot keys.

    Rows of a hot key are dealt over ``salts`` tasks (as many as partitions) and
    its single dimension row is repeated that often. Without hot keys this is a plain join, which
    Spark turns into a broadcast join when the measured size allows.
    """
    if not hot:
        return fact.join(dim, on, how)
    salts = salts or parts_of(fact)
    is_hot = among(on, hot)
    spread = fact.withColumn(
        "_salt", F.when(is_hot, F.pmod(F.xxhash64(*fact.columns), F.lit(salts))).otherwise(F.lit(0))
    )
    every_salt = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    repeated = dim.withColumn(
        "_salt", F.explode(F.when(is_hot, every_salt).otherwise(F.array(F.lit(0).cast("bigint"))))
    )
    return spread.join(repeated, [on, "_salt"], how).drop("_salt")
