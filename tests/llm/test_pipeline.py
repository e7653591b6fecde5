"""Each stage against a brute-force version over its own input."""

from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm import common, mixing, quality, queries, sharding
from test_decontamination import brute as brute_matches
from test_jaccard import brute as brute_groups

DATA = "/root/testdata/sf0.001"


def plain(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents before and after each stage."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    extra = docs.filter("doc_id < 60").withColumn("text", F.concat("text", F.lit(" tail"))).withColumn("doc_id", F.col("doc_id") + 10_000)
    odd = spark.createDataFrame([(20_000, None, None, None, None), (20_001, "", "en", None, 0)], docs.schema)
    docs = docs.unionByName(extra).unionByName(odd).withColumn("_row", F.lit("clash"))
    out = [docs]
    for name, function in corpus_pipeline.STAGES:
        function(spark, out[-1], DATA).write.parquet(f"{folder}/{name}")
        out.append(spark.read.parquet(f"{folder}/{name}"))
    return out


def test_names_and_columns(stages):
    assert len(corpus_pipeline.STAGES) == 5
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns
    assert stages[-1].columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def test_quality_stage(spark, stages):
    model = quality.fit(stages[0], spark.read.parquet(f"{DATA}/labels.parquet"))
    scores = {r.doc_id: model.score(quality.statistics(r.text)[None])[0] for r in stages[0].collect()}
    rejected = {doc for doc, score in scores.items() if score < 0.5}
    assert {r.doc_id for r in stages[1].collect()} == set(scores) - rejected
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    good = [doc for doc in scores if labels.get(doc) == 1]
    assert sum(doc in rejected for doc in good) <= 0.05 * len(good)


def test_near_copies_stage(stages):
    groups = brute_groups([(r.doc_id, r.text) for r in stages[1].collect()])
    want = {doc for doc, n, least in groups if n == 0 or doc == least}
    got = [r.doc_id for r in stages[2].collect()]
    assert sorted(got) == sorted(want) and len(want) < len(groups)


def test_benchmark_stage(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in stages[2].collect()]
    bad = {doc for doc, _ in brute_matches(rows, items)}
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted({doc for doc, _ in rows} - bad) and bad


def test_mix_stage(stages):
    copies = Counter(r.doc_id for r in stages[4].collect())
    given = stages[3].collect()
    sizes, words, taken = {}, Counter(), Counter()
    for r in given:
        sizes[r.doc_id] = sum(1 for w in (r.text or "").translate(str.maketrans("\t\n\v\f\r", "     ")).split(" ") if w)
        key = mixing.MISSING if r.source is None else "=" + r.source
        words[key] += sizes[r.doc_id]
        taken[key] += copies[r.doc_id] * sizes[r.doc_id]
    assert set(copies) <= set(sizes) and max(copies.values()) <= 2
    for key, target in mixing.targets(dict(words), (5, 2, 1), 1.5, 2).items():
        largest = max(sizes[r.doc_id] for r in given if key == (mixing.MISSING if r.source is None else "=" + r.source))
        assert abs(taken[key] - target) <= largest / 2 + 1


def test_shard_stage(stages):
    rows = stages[5].collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in stages[4].collect())
    places = sorted((r.shard, r.slot) for r in rows)
    assert places == sorted(sharding.locate(i, len(rows), queries.SHARDS, queries.SHARD_SEED) for i in range(len(rows)))


def test_run_and_empty_tables(spark):
    assert corpus_pipeline.run(spark, DATA).count() > 100
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, function in corpus_pipeline.STAGES:
        assert function(spark, docs, DATA).count() == 0


def largest_batch(spark, rows):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    texts = spark.range(rows, numPartitions=1).select(F.repeat(F.lit("x"), 4_000).alias("text"))
    return texts.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0]


@pytest.mark.parametrize("name", ["quality", "near copies", "benchmark"])
def test_texts_go_to_python_in_batches_by_bytes(spark, name):
    own = spark.newSession()
    docs = own.read.parquet(f"{DATA}/documents.parquet").limit(20)
    dict(corpus_pipeline.STAGES)[name](own, docs, DATA)
    assert largest_batch(own, 2_000) < 1.5 * common.BATCH_BYTES


def test_batches_of_a_session_that_bounds_them(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4000000")
    common.bound_batches(own)
    assert own.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "4000000"


def test_the_mix_starts_no_python_workers(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    mixed = mixing.mix(docs, F.array(mixing.source_key(F.col("source"))))
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and "LocalTableScan" in plan
