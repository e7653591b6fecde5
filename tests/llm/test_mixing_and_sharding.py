import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import mixing, queries, sharding

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, "a b c", "en", "x", 5),
        (1, "a b c", "en", "x", 5),
        (2, "", "en", "x", 0),
        (3, None, None, None, None),
        (None, "lost id", "en", None, 7),
        (4, "w " * 50_000, "en", "y", 100_000),
        (5, "é \x0b ü", "fr", "y", 5),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def by_source(df):
    return df, F.array(mixing.source_key(F.col("source")))


def test_targets_share_the_excess():
    assert mixing.targets({"a": 100, "b": 100, "c": 100}, (5, 2, 1), 1.5, 2) == {
        "a": 200.0,
        "b": pytest.approx(500 / 3),
        "c": pytest.approx(250 / 3),
    }
    assert mixing.targets({}, (5, 2, 1), 1.5, 2) == {}


def test_route_prefers_new_words_and_reroutes():
    flow = mixing.route({("a",): 10, ("a", "b"): 10, ("b",): 0}, {"a": 10, "b": 10}, 2)
    assert flow == {("a",): 10, ("a", "b"): 10, ("b",): 0}
    flow = mixing.route({("a",): 10, ("b",): 5}, {"a": 15, "b": 20}, 2)
    assert flow == {("a",): 15, ("b",): 10}


def least_cost(patterns, quotas, repeats):
    """All flows of a tiny network: most words first, then fewest repeats."""
    names = list(patterns)
    best = None

    def go(k, left, taken):
        nonlocal best
        if k == len(names):
            cost = sum(max(0, t - patterns[n] * r) for n, t in zip(names, taken, strict=True) for r in range(1, repeats))
            key = (-sum(taken), cost)
            best = key if best is None or key < best else best
            return

        def split(members, room, left, took):
            if not members:
                go(k + 1, left, taken + [took])
                return
            for x in range(min(room, left[members[0]]) + 1):
                split(members[1:], room - x, left | {members[0]: left[members[0]] - x}, took + x)

        split(names[k], repeats * patterns[names[k]], left, 0)

    go(0, quotas, [])
    return best


def test_route_against_all_flows():
    patterns = {("a",): 1, ("a", "b"): 2, ("b", "c"): 2, ("c",): 1}
    for quotas in ({"a": 3, "b": 2, "c": 2}, {"a": 1, "b": 4, "c": 1}, {"a": 5, "b": 5, "c": 5}):
        flow = mixing.route(patterns, quotas, 2)
        cost = sum(max(0, flow[p] - patterns[p]) for p in patterns)
        assert (-sum(flow.values()), cost) == least_cost(patterns, quotas, 2)


def test_mix_against_brute_force(spark):
    out = queries.QUERIES["op1_mix_sources"](spark, DATA).collect()
    given = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    source = {r.doc_id: r.source for r in given}
    sizes, largest, taken = Counter(), Counter(), Counter()
    for r in given:
        n = len((r.text or "").translate(str.maketrans("\t\n\v\f\r", "     ")).split(" "))
        n -= (r.text or "").translate(str.maketrans("\t\n\v\f\r", "     ")).split(" ").count("")
        sizes[mixing.MISSING if r.source is None else "=" + r.source] += n
    wanted = mixing.targets(dict(sizes), (5, 2, 1), 1.5, 2)
    for r in out:
        key = mixing.MISSING if source[r.doc_id] is None else "=" + source[r.doc_id]
        assert r.source_size == sizes[key]
        assert r.target == pytest.approx(wanted[key])
        assert r["taken"] <= 2 * r["size"]
        assert r["size"] == 0 or r["taken"] % r["size"] == 0
        taken[key] += r["taken"]
        largest[key] = max(largest[key], r["size"])
    assert len(out) == len(given)
    for key in sizes:
        assert abs(taken[key] - wanted[key]) <= largest[key] / 2 + 1
    again = queries.QUERIES["op1_mix_sources"](spark, DATA).collect()
    assert sorted(out) == sorted(again)


def test_mix_edges(spark, docs):
    clash = docs.withColumn("members", F.lit(1)).withColumn("_draw", F.lit(1)).withColumn("draw", F.lit(2))
    out = mixing.mix(*by_source(clash)).collect()
    assert Counter(r.doc_id for r in out) == Counter([1, 1, 2, 3, None, 4, 5])
    assert {r.doc_id: r["size"] for r in out} == {1: 3, 2: 0, 3: 0, None: 2, 4: 50_000, 5: 2}
    assert mixing.mix(*by_source(docs.limit(0))).count() == 0


def test_mix_of_overlapping_sources(spark):
    rows = [(k, "w " * 10, ["a"] if k % 3 == 0 else ["b", "a"] if k % 3 == 1 else []) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, s array<string>")
    out = mixing.mix(df, F.col("s"), weights=(1, 1), share=0.5).collect()
    assert sum(r["taken"] for r in out if not r.members) == 0
    # a: 2,000 words, b: 1,000; half of all is 1,500, shared 750 and 750
    assert sum(r["taken"] for r in out) == 1500


def test_take_mix_repeats_rows(spark, docs):
    mixed = defaultdict(int)
    for r in mixing.mix(*by_source(docs)).collect():
        mixed[r.doc_id] += r.copies
    got = Counter(r.doc_id for r in mixing.take_mix(*by_source(docs)).collect())
    for doc in (2, 4, 5):
        assert got[doc] == mixed[doc]
    assert mixing.take_mix(*by_source(docs)).columns == docs.columns


def test_locate_is_a_permutation_with_an_inverse():
    for rows in (1, 2, 3, 5, 17, 100, 1000):
        seen = set()
        for row in range(rows):
            shard, slot = sharding.locate(row, rows, 7, 3)
            assert sharding.row_at(shard, slot, rows, 7, 3) == row
            seen.add((shard, slot))
        assert seen == {(x % 7, x // 7) for x in range(rows)}


def test_shards_against_brute_force(spark):
    given = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    keys = sorted((r.doc_id, zlib.crc32(r.text.encode()), len(r.text.encode()) + 1) for r in given)
    want = [(*key, *sharding.locate(i, len(keys), 16, queries.SHARD_SEED)) for i, key in enumerate(keys)]
    out = queries.QUERIES["op3_feistel_shards"](spark, DATA).collect()
    assert sorted((r.doc_id, r.text_crc32, r["size"], r.shard, r.slot) for r in out) == want


def test_shard_edges(spark, docs):
    clash = docs.withColumn("_row", F.lit(1)).withColumn("_part", F.lit(1)).withColumn("shard", F.lit("x"))
    out = sharding.shard_rows(clash, 3, 5).collect()
    assert sorted((r.shard, r.slot) for r in out) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (2, 0), (2, 1)]
    assert {r["size"]: r.text_crc32 for r in out}[1] == 0
    assert sharding.shard_rows(docs.limit(0), 3, 5).count() == 0
