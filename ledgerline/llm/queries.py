"""The registered query of each operator, and its SQL check where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import decontamination, extraction, jaccard, merkle, mixing, oracle, pii, quality, rules, search, sharding, spelling, toxicity, warc
from ledgerline.llm.common import held_out, table
from ledgerline.sources.tables import stage_path

SHARDS = 16
SHARD_SEED = 2024
PII_KEY = b"key of the test tables; a user brings an own one"


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, F.array(mixing.source_key(F.col("source"))))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").filter(search.usable(F.col("embedding")))
    vectors = rows.select("vec_id", search.scaled(F.col("embedding")).alias("vector"))
    return search.top_k(vectors, F.col("vec_id") % 50 == 0)


def op3_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"), SHARDS, SHARD_SEED)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.linked(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def op5_benchmark_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("h1", "h2")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.fit(docs, table(spark, sf_dir, "labels")).scored(docs)
    return _digest(scored, 0.7)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return _digest(docs.withColumn("score", quality.score_of(F.col("text"), model)), 0.5)


def _digest(scored: DataFrame, limit: float) -> DataFrame:
    predicted = (F.col("score") >= limit).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


def op8_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonyms(table(spark, sf_dir, "documents"), PII_KEY)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = stage_path(spark, "warc")
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    read = warc.read_archives(spark, folder, manifest, payloads=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = extraction.main_text(F.col("html"), extraction.trained())
    read = table(spark, sf_dir, "pages").select("page_id", "url", text.alias("text"))
    return read.withColumn("n_chars", F.char_length("text").cast("long"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proofs(table(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    forest = rules.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return rules.judged(docs, forest)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_mix_sources,
        op2_pivot_search,
        op3_feistel_shards,
        op4_jaccard_join,
        op5_benchmark_matches,
        op6_toxicity,
        op7_quality,
        op8_pseudonyms,
        op9_warc,
        op10_main_text,
        op11_merkle_manifest,
        op12_quality_rules,
        op13_spelling_variants,
    )
}

#: The others train models, draw by hash, compare word shingles or rewrite texts; the tests hold them against brute force.
ORACLE: dict[str, str] = {
    "op2_pivot_search": oracle.SEARCH,
    "op3_feistel_shards": oracle.shards(SHARDS, SHARD_SEED),
    "op9_warc": oracle.ARCHIVE,
    "op11_merkle_manifest": oracle.MERKLE,
    "op13_spelling_variants": oracle.SPELLING,
}
