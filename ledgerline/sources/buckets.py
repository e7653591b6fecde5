"""Tables in hash buckets of a key, of which a version rewrites only those it touches.

A version's folder holds the rows of its buckets, one folder each, and beside
them a list with one row per bucket. The rows of the table are those of the
newest complete version of each bucket, so a small change to a large table
writes few files, and the files of all other buckets stay as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.sources.versions import LOG, SCHEMA, Versions

BUCKETS = 256
_TOUCHED = "bucket int, count long, version string"


class Buckets:
    def __init__(self, versions: Versions, table: str, key: str, schema: T.StructType, buckets: int = BUCKETS) -> None:
        self.versions, self.table, self.key, self.schema, self.buckets = versions, table, key, schema, buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def touched(self, keys: DataFrame) -> list[int]:
        """Buckets in which the keys of ``keys`` lie; at most ``buckets`` numbers."""
        return sorted(row.b for row in keys.select(self.bucket().alias("b")).distinct().collect())

    def newest(self) -> dict[int, str | None]:
        """The folder of each bucket ever written, by the newest complete version; None if it is empty there."""
        spark, folder = self.versions.spark, self.versions.folder
        done = self.versions.complete()
        if not done:
            return {}
        lists = [f"{self.versions.path(version)}/{self.table}_buckets" for version in done]
        log = spark.read.schema(SCHEMA).parquet(f"{folder}/{LOG}")
        held = spark.read.schema(_TOUCHED).parquet(*lists).join(log, "version")
        last = held.groupBy("bucket").agg(F.max_by(F.struct("version", "count"), "place").alias("at"))
        return {  # one row per bucket
            row.bucket: f"{self.versions.path(row.at['version'])}/{self.table}/bucket={row.bucket}" if row.at["count"] else None
            for row in last.collect()
        }

    def read(self, folders: Sequence[str]) -> DataFrame:
        spark = self.versions.spark
        if not folders:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*folders)

    def split(self, touched: Sequence[int]) -> tuple[DataFrame, DataFrame]:
        """Rows of the given buckets, and all other rows."""
        newest = self.newest()
        hit, rest = [], []
        for bucket, folder in sorted(newest.items()):
            if folder:
                (hit if bucket in set(touched) else rest).append(folder)
        return self.read(hit), self.read(rest)

    def current(self) -> DataFrame:
        return self.split([])[1]

    def rewrite(self, rows: DataFrame, touched: Sequence[int], version: str) -> DataFrame:
        """Write ``rows`` as all that the given buckets hold from ``version`` on, and read them back.

        Spark cuts large buckets into several tasks and joins small ones up. Runs
        inside ``Versions.writing``; what a stopped run left is replaced.
        """
        spark, path = self.versions.spark, self.versions.path(version)
        placed = rows.select(*self.schema.fieldNames()).withColumn("bucket", self.bucket())
        placed.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/{self.table}")
        stored = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])
        written = spark.read.schema(stored).parquet(f"{path}/{self.table}")
        asked = spark.createDataFrame([(b,) for b in touched], "bucket int")
        counts = asked.join(written.groupBy("bucket").count(), "bucket", "left")
        listed = counts.select("bucket", F.coalesce("count", F.lit(0)).alias("count"), F.lit(version).alias("version"))
        listed.coalesce(1).write.mode("overwrite").parquet(f"{path}/{self.table}_buckets")
        return written.drop("bucket")
