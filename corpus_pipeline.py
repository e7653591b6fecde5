"""The corpus pipeline: stages over `documents`, each written and read again by the next.

Every stage is a function of (spark, docs, sf_dir). All but the last return the
columns of `documents`; the last returns shards and slots. A stage works on all
rows its predecessor kept, copes with missing values and empty tables as its
operator does, and keeps further columns. Stages that hand texts to Python bound
the bytes of their batches in the session, since a result is computed by its reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import decontamination, jaccard, mixing, quality, sharding
from ledgerline.llm.common import bound_batches, table
from ledgerline.llm.queries import SHARD_SEED, SHARDS
from ledgerline.sources.tables import stage


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    bound_batches(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.filter(quality.score_of(F.col("text"), model) >= 0.5)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies, that of the smallest id."""
    bound_batches(spark)
    return jaccard.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage that matches a benchmark item."""
    bound_batches(spark)
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.take_mix(docs, F.array(mixing.source_key(F.col("source"))))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row that is left."""
    return sharding.shard_rows(docs, SHARDS, SHARD_SEED)


STAGES = [
    ("quality", keep_quality),
    ("near copies", drop_near_copies),
    ("benchmark", drop_benchmark),
    ("mix", mix_sources),
    ("shard", shard),
]

#: The stages train a classifier and compare by hashes; the tests hold them against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
