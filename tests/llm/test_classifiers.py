import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import quality, queries, toxicity

DATA = "/root/testdata/sf0.01"
#: Target, limit, data and the least area; some labels are wrong on purpose, and the smaller data hold few toxic rows.
NAMES = {
    "op6_toxicity": ("toxic", 0.7, "/root/testdata/sf0.1", 0.97),
    "op7_quality": ("quality", 0.5, "/root/testdata/sf0.01", 0.99),
}


def area(scores, labels):
    """Chance that a row of label 1 is scored above one of label 0."""
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    for value in set(scores):
        same = np.array(scores) == value
        ranks[same] = ranks[same].mean()
    ones = np.array(labels) == 1
    return (ranks[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())


@pytest.mark.parametrize("name", sorted(NAMES))
def test_held_out_accuracy(spark, name):
    target, limit, data, least = NAMES[name]
    rows = queries.QUERIES[name](spark, data).collect()
    assert len(rows) == spark.read.parquet(f"{data}/documents.parquet").count()
    labels = {r.doc_id: r[target] for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= limit)
    unseen = [(r.score, r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    scores, predicted, truth = zip(*unseen, strict=True)
    assert area(scores, truth) > least
    assert np.mean(np.array(predicted) == np.array(truth)) > 0.97


def test_held_out_labels_are_not_read(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    turned = labels.withColumn(
        "quality",
        F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")),
    )
    one, two = quality.fit(docs, labels), quality.fit(docs, turned)
    assert np.allclose(one.weights, two.weights) and np.allclose(one.levels, two.levels)


def test_normal_equations_against_one_pass(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    model = quality.fit(docs, labels)
    rows = quality.training_rows(docs, labels, "quality", quality.MOST_ROWS).filter("part > 0").collect()
    stats = np.stack([quality.statistics(r.text) for r in rows])
    assert np.allclose(stats.mean(0), model.centre)
    z, y = model.features(stats), np.array([r.label for r in rows], dtype=float)
    want = np.linalg.solve(z.T @ z + quality.RIDGE * len(z) * np.eye(z.shape[1]), z.T @ y)
    assert np.allclose(model.raw(stats), z @ want, atol=1e-6)
    assert (np.diff(model.levels) >= 0).all()


def edges(spark):
    rows = [(1, None, 1, 1), (2, "", 0, 0), (3, "word " * 30_000, 1, None), (None, "no id", None, 1), (4, "you idiot", 0, 1)]
    rows += [(4, "you idiot", 0, 1)] + [(k, f"text number {k} is fine.", 1, 0) for k in range(10, 40)]
    rows += [(k, f"you stupid idiot {k}!!", 0, 1) for k in range(40, 70)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int")
    return df.select("doc_id", "text", F.lit("x").alias("label"), F.lit(1).alias("part")), df.drop("text")


def test_quality_edges(spark):
    docs, labels = edges(spark)
    model = quality.fit(docs, labels)
    got = docs.withColumn("score", quality.score_of(F.col("text"), model)).collect()
    assert len(got) == 66 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if not r.text}) == 1
    assert quality.fit(docs, labels.limit(0)) == 0.5
    assert quality.fit(docs, labels.withColumn("quality", F.lit(1))) == 1.0
    assert docs.limit(0).withColumn("score", quality.score_of(F.col("text"), model)).count() == 0


def test_toxicity_edges(spark):
    docs, labels = edges(spark)
    model = toxicity.fit(docs, labels)
    got = model.scored(docs).collect()
    assert len(got) == 66 and all(0 <= r.score <= 1 for r in got)
    bad = [r.score for r in got if r.text and "idiot" in r.text]
    good = [r.score for r in got if r.text and "fine" in r.text]
    assert min(bad) > max(good)
    assert {r.score for r in toxicity.fit(docs, labels.limit(0)).scored(docs).collect()} == {0.5}
    assert model.scored(docs.limit(0)).count() == 0
    clashing = ["_features", "_raw", "_level", "_chance", "_margin", "_class", "_row", "Score", "a.b"]
    wide = docs.select("*", *[F.lit(name).alias(name) for name in clashing])
    for one in (model, toxicity.fit(docs, labels.limit(0))):
        made = one.scored(wide)
        assert made.columns == [*docs.columns, *[name for name in clashing if name != "Score"], "score"]
        assert {tuple(r[name] for name in clashing if name != "Score") for r in made.collect()} == {
            tuple(name for name in clashing if name != "Score")
        }
    scores = {(r.doc_id, r.text): r.score for r in got}
    assert {(r.doc_id, r.text): r.score for r in model.scored(wide).collect()} == scores


def test_toxic_features():
    f = toxicity.Features({"plonk": 8.0, "grumb*": 7.0, "weak": 1.0}, ["idiot", "scum"])
    assert f(None) == f("") == [0.0] * toxicity.FEATURES
    plain, near = f("the idiot was there with no one"), f("you are an idiot")
    assert near[7] == 1.0 and plain[7] == 0.0 and near[0] > 0
    hidden = f("such an 1d10t and s.c.u.m and i d i o t")
    assert hidden[17] == 3 and hidden[0] > 0
    assert f("PLONK!!")[2] == f("grumbles")[2] == 100.0 and f("grumb weak")[2] == 0.0
