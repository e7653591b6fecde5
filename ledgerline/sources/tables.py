"""Reading and writing tables: scans, dimensions, dictionaries, sinks, stages."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, directory: str | None, name: str) -> DataFrame:
    """A parquet table of a directory; without one, a table of the catalog."""
    if directory is None:
        return spark.table(name)
    return spark.read.parquet(f"{directory}/{name}.parquet")


def scan_entities(items: DataFrame, kind: str, since: Column | str | None = None) -> DataFrame:
    """Rows of one entity kind from a table that mixes kinds.

    ``since`` is compared with the raw ``createddate`` text, so a table
    partitioned by that column reads only the recent partitions.
    """
    rows = items.where(F.col("__en") == kind)
    if since is None:
        return rows
    return rows.where(F.col("createddate") >= (F.lit(since) if isinstance(since, str) else since))


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])


def load_dimension(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A sheet-like file: header row, every value text, lower-case names."""
    return lower_names(spark.read.csv(path, header=True, inferSchema=False, sep=sep))


def load_category_map(spark: SparkSession, path: str, value: str = "category1", per_line: bool = False) -> DataFrame:
    """JSON objects of noun to category as rows (noun, ``value``): one per file, or one per line.

    A file of one object is one row while it is read, so large maps are better
    kept as lines, which any number of tasks can read.
    """
    text = spark.read.text(path, wholetext=not per_line)
    pairs = F.from_json("value", T.MapType(T.StringType(), T.StringType()))
    return text.select(F.explode(pairs).alias("noun", value))


def load_noun_list(spark: SparkSession, path: str) -> DataFrame:
    """First word of each line; the tag after it may follow any white space."""
    words = spark.read.text(path).select(F.split(F.trim("value"), r"\s+")[0].alias("noun"))
    return words.where(F.col("noun") != "").distinct()


def append_rows(df: DataFrame, path: str) -> None:
    lower_names(df).write.mode("append").parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Replace all rows, also when ``df`` is empty. ``df`` must not read ``path``."""
    lower_names(df).write.mode("overwrite").parquet(path)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in order and type; those ``df`` lacks become NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def append_new(df: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not stored yet (to append). A NULL key is new."""
    return df.join(stored.select(key), key, "left_anti")


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """What is left after deleting rows for which the predicate is true."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def delete_matching(stored: DataFrame, staged: DataFrame, on: Sequence[str], differs: str) -> DataFrame:
    """Stored rows without a staged row equal on ``on`` and unequal on ``differs``.

    A staged value unequal to the stored one exists exactly when the smallest
    or the largest staged value is unequal, so two aggregates per key replace
    the pairs.
    """
    keys = list(on)
    ends = staged.groupBy(*keys).agg(F.min(differs).alias("_low"), F.max(differs).alias("_high"))
    hit = (F.col("_low") != F.col(differs)) | (F.col("_high") != F.col(differs))
    return delete_where(stored.join(ends, keys, "left"), hit).select(*stored.columns)


FOLDER = "ledgerline.stage.dir"  # set by a caller whose session names no checkpoint folder


def stage_dir(spark: SparkSession) -> str:
    """The shared folder the session names; there is no machine-local default.

    Some steps read back what they staged while they replace its source, so
    staging must never turn into a lazy frame: without a folder this fails.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(FOLDER, None)
    if not folder:
        raise ValueError(f"set spark.checkpoint.dir (or {FOLDER}) to a folder all executors share")
    return folder.rstrip("/")


def stage_path(spark: SparkSession, label: str) -> str:
    return f"{stage_dir(spark)}/{label}-{uuid.uuid4().hex}"


COMPACT = "zstd"  # for staged tables that count by their size; the others take the session's codec
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_scopes = threading.local()


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables staged by this thread inside go at the end: their readers must have been written by then."""
    outer, _scopes.paths = getattr(_scopes, "paths", None), []
    try:
        yield
    finally:
        inside, _scopes.paths = _scopes.paths, outer
        for path in inside if hasattr(spark, "_jvm") else []:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def stage(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write a result that several steps read, and read it back.

    Cuts lineage, survives lost executors and lets each reader scan only its
    columns.
    """
    return stage_parts([df], label, codec)


def stage_parts(parts: Iterable[DataFrame], label: str, codec: str | None = None) -> DataFrame:
    """``stage`` for a result that comes in parts, one after the other, each built when the one before is written.

    With a codec the shuffle files of a part go as soon as it is written; a plan
    that is run once needs them no more.
    """
    paths, scope = [], getattr(_scopes, "paths", None)
    for df in parts:
        spark = df.sparkSession
        paths.append(stage_path(spark, label))
        if codec is None:
            df.write.parquet(paths[-1])
            continue
        before = spark.conf.get(CLEAN_UP, None)
        spark.conf.set(CLEAN_UP, "true")
        try:
            df.write.option("compression", codec).parquet(paths[-1])
        finally:
            spark.conf.unset(CLEAN_UP) if before is None else spark.conf.set(CLEAN_UP, before)
    if scope is not None:
        scope += paths
    return spark.read.schema(df.schema).parquet(*paths)
