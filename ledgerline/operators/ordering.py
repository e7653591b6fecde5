"""Exact positions and running totals over a whole table, without one big group.

The rows are cut by range over the order columns and stored once with their
part number, so that every later reader sees the same parts. Positions and
totals are windows inside a part plus the sums of the parts before it, one row
per part. A key with many rows spans several parts; a last order column that is
unique per row lets the cut fall between equal rows, too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.sources.tables import stage


def cut(df: DataFrame, order: Sequence[str | Column], label: str, codec: str | None = None) -> DataFrame:
    """`df` stored in range parts over `order`, with the part number in `_part`."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    return stage(ranged, label, codec)


def positions(stored: DataFrame, order: Sequence[str | Column], size: Column | None = None) -> DataFrame:
    """A stored cut with `_row`, the position from 0, and `_before`, the sum of `size` over the rows before."""
    amount = F.lit(0).cast("long") if size is None else size.cast("long")
    sized = stored.withColumn("_size", amount)
    totals = sized.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_sum"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_part",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_rows_before"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_size_before"),
    )
    inside = Window.partitionBy("_part").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    numbered = sized.withColumn("_row", F.row_number().over(inside) - 1).withColumn(
        "_before", F.sum("_size").over(upto) - F.col("_size")
    )
    return (
        numbered.join(offsets, "_part")
        .withColumn("_row", F.col("_row") + F.col("_rows_before"))
        .withColumn("_before", F.col("_before") + F.col("_size_before"))
        .drop("_part", "_size", "_rows_before", "_size_before")
    )
