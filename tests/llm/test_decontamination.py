import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import decontamination, queries

DATA = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def grams(words, length):
    return [tuple(words[i : i + length]) for i in range(len(words) - length + 1)]


def brute(docs, items):
    """The best similarity of any window of the item's length, over all windows of all documents."""
    out = {}
    known = {}
    for item, text in items:
        w = words(text)
        if w and item is not None:
            known[item] = (len(w), Counter(grams(w, min(5, len(w)))))
    for doc, text in docs:
        w = words(text)
        for item, (size, bag) in known.items():
            length = min(5, size)
            if not set(bag) & set(grams(w, length)):
                continue
            for start in range(max(1, len(w) - size + 1)):
                seen = Counter(grams(w[start : start + size], length))
                score = sum((seen & bag).values()) / sum((seen | bag).values())
                if score >= 0.8:
                    out[doc, item] = max(score, out.get((doc, item), 0))
    return out


def pairs(df):
    return {(r.doc_id, r.item_id): pytest.approx(r.similarity) for r in df.collect()}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_brute_force(spark, sf):
    data = f"/root/testdata/{sf}"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    assert brute(docs, items) == pairs(queries.QUERIES["op5_benchmark_matches"](spark, data))


def planted():
    draw = random.Random(2)
    noise = lambda n: [f"n{draw.randrange(10**6)}" for _ in range(n)]
    items = [(k, " ".join(f"b{draw.randrange(10**6)}" for _ in range(n))) for k, n in enumerate([1, 3, 4, 5, 6, 9, 15, 30, 57, 200])]
    items += [(20, "the same words the same words the same words the same words the end of it")]
    docs = []
    for item, text in items:
        w = text.split()
        docs.append((len(docs), text))
        docs.append((len(docs), " ".join(noise(50) + w + noise(70)).upper().replace(" ", ", ", 30)))
        for changes in (1, 2, 3):
            v = list(w)
            for _ in range(changes):
                v[draw.randrange(len(v))] = "changed"
            docs.append((len(docs), " ".join(noise(30) + v + noise(30))))
        docs.append((len(docs), " ".join(noise(30) + w[: len(w) * 9 // 10] + noise(30))))
        docs.append((len(docs), " ".join(w[: max(1, len(w) * 19 // 20)])))
    docs.append((len(docs), " ".join(noise(500))))
    return docs, items


def test_planted_passages(spark):
    docs, items = planted()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert len(want) > 30
    assert pairs(decontamination.matches(df, bench)) == want


def test_edges_and_clean(spark):
    rows = [(1, None), (2, ""), (None, "one two three four five six seven"), (3, "ok " * 30_000), (4, "clean text")]
    rows += [(5, "x One two three, four five six SEVEN y")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h1", F.lit("h")).withColumn("words", F.lit(1))
    bench = spark.createDataFrame(
        [(1, "one two three four five six seven"), (2, None), (3, "..."), (None, "clean text")], "item_id long, text string"
    ).withColumn("words", F.lit("w"))
    assert pairs(decontamination.matches(docs, bench)) == {(None, 1): 1.0, (5, 1): 1.0}
    kept = decontamination.clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4]
    assert decontamination.matches(docs.limit(0), bench).count() == 0
    assert decontamination.matches(docs, bench.limit(0)).count() == 0
    assert decontamination.clean(docs, bench.limit(0)).count() == docs.count()


def test_items_without_an_id_clean_documents(spark):
    rows = [(1, "x one two three four five six seven y"), (2, "a b c d e"), (3, "something else that is clean")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = [(None, "one two three four five six seven"), (None, "A b, c d e!"), (4, "not in any of the documents")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert [r.doc_id for r in decontamination.clean(docs, bench).collect()] == [3]
    assert decontamination.matches(docs, bench).count() == 0


def test_radius_covers_the_similarity():
    """Windows at the threshold lie within the radius; the blocks meet every fingerprint within it."""
    random = np.random.default_rng(1)
    missed = total = 0
    for size in (1, 5, 10, 11, 20, 40, 53, 100):
        for _ in range(400):
            a = random.integers(0, 2**64, size, dtype=np.uint64)
            b = a.copy()
            b[: size - decontamination.enough(size)] = random.integers(
                0, 2**64, size - decontamination.enough(size), dtype=np.uint64
            )
            if decontamination.similarity(a, b) >= 0.8:
                x, y = (int(decontamination.fingerprints(s, np.zeros(1, dtype=np.int64), size)[0]) for s in (a, b))
                apart = (x ^ y).bit_count()
                missed += apart > decontamination.RADIUS
                total += 1
                if apart <= decontamination.RADIUS:
                    assert min(((x ^ y) >> 8 * k & 255).bit_count() for k in range(8)) <= 2
    assert total > 2000 and missed == 0
