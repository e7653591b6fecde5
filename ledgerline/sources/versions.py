"""Versions of a set of tables that come into force together.

Every version is written to a folder of its own, never over another one. A log
beside them, itself a table, names the versions that are complete, one row each;
that row is written last, by one Spark job with one task, whose output appears as
a whole or not at all. Readers go by the log, so they see all tables of a version
or none, and a run that stopped leaves nothing but an unnamed folder, which a
repeated run under the same name replaces.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "_versions"
SCHEMA = "place long, version string"


class Versions:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def complete(self) -> list[str]:
        """Names of the complete versions, in the order in which they came into force."""
        try:
            rows = self.spark.read.schema(SCHEMA).parquet(f"{self.folder}/{LOG}")
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return []
        # One row per version: as many as there were runs.
        return [row.version for row in rows.orderBy("place", "version").collect()]

    def path(self, version: str) -> str:
        return f"{self.folder}/{version}"

    @contextmanager
    def writing(self, version: str) -> Iterator[str]:
        """A folder to write the tables of ``version`` to; it counts when the block ends without an error.

        Writers in it must replace what a stopped run left there. A version that
        is complete is not written again.
        """
        done = self.complete()
        if version in done:
            raise ValueError(f"version {version} is complete")
        yield self.path(version)
        row = self.spark.range(1).select(F.lit(len(done)).cast("long").alias("place"), F.lit(version).alias("version"))
        row.coalesce(1).write.mode("append").parquet(f"{self.folder}/{LOG}")

    def latest(self, table: str) -> DataFrame:
        """A table of the last complete version."""
        done = self.complete()
        if not done:
            raise ValueError(f"no complete version in {self.folder}")
        return self.spark.read.parquet(f"{self.path(done[-1])}/{table}")

    def all_rows(self, table: str) -> DataFrame:
        """A table that versions add to: its rows over all complete versions."""
        done = self.complete()
        if not done:
            raise ValueError(f"no complete version in {self.folder}")
        return self.spark.read.parquet(*[f"{self.path(version)}/{table}" for version in done])
