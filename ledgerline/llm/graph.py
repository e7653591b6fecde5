"""Connected components by alternating large and small stars, without driver-side links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.sources.tables import stage


def _stars(edges: DataFrame) -> bool:
    """Whether every node of the edges (`u`, smaller `v`) is the smaller end of all its edges or the larger end of one."""
    ends = F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))
    nodes = edges.select(F.explode(ends).alias("end")).groupBy("end.node")
    nodes = nodes.agg(F.sum("end.up").alias("up"), F.count(F.lit(1)).alias("edges"))
    return nodes.filter("up > 0 and edges > 1").agg(F.count(F.lit(1))).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """`node` and `root` (smallest node reachable) of every node of the edges (`a`, `b`, long).

    A large star links the larger neighbours of each node to its smallest one, a
    small star the smaller ones; minima are combined before the shuffle. Each
    round is written to the shared folder; about log(n) rounds are needed, and none
    where all edges are stars already.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    now = stage(now, "components")
    while not _stars(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        moved = small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stage(small.select("u", F.col("m").alias("v")).unionByName(moved).distinct(), "components")
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )
