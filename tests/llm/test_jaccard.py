import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import graph, jaccard, queries
from ledgerline.llm import shingles as hashing
from ledgerline.sources.tables import stage

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """Components by all pairs that share a shingle."""
    sets = [shingles(text) for _, text in rows]
    place = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            place[x].append(i)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, s in enumerate(sets):
        near = defaultdict(int)
        for x in s:
            for j in place[x]:
                if j < i:
                    near[j] += 1
        for j, both in near.items():
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)), key=repr)


def got(df):
    return sorted(((r.doc_id, r.n, r.component_id) for r in jaccard.linked(df).collect()), key=repr)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_brute_force(spark, sf):
    data = f"/root/testdata/{sf}"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    out = queries.QUERIES["op4_jaccard_join"](spark, data).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out) == sorted(brute(rows))


def test_chains_near_copies_and_small_texts(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PAGE", 8)
    draw = random.Random(5)
    rows = []

    def add(words):
        rows.append((len(rows) + 100, " ".join(words)))

    for length in (1, 2, 4, 5, 8, 9, 13, 30, 64, 70, 127, 128, 300, 1100):
        words = [f"w{draw.randrange(10**6)}" for _ in range(length)]
        add(words)
        add([w.upper() for w in words])
        for _ in range(4):  # a chain: each step changes a little more
            words = list(words)
            for _ in range(max(1, length // 60)):
                words[draw.randrange(length)] = f"x{draw.randrange(10**6)}"
            add(words)
        add(words + ["tail"])
        add(words[: max(1, length * 9 // 10)])
    base = [f"c{i}" for i in range(200)]
    for _ in range(60):  # one large group of near copies
        words = list(base)
        words[draw.randrange(200)] = f"y{draw.randrange(10**6)}"
        words[draw.randrange(200)] = f"y{draw.randrange(10**6)}"
        add(words)
    license_ = [f"l{i}" for i in range(60)]
    for _ in range(40):  # a passage that many texts share
        add([f"z{draw.randrange(10**6)}" for _ in range(60)] + license_)
    draw.shuffle(rows)
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == brute(rows)


def test_edges(spark):
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "x", 0),
        (3, " \t\n", "en", "x", 3),
        (None, "a b c", "en", "x", 5),
        (4, "A b\tC", "en", "x", 5),
        (None, "lost without an id", None, None, None),
        (5, "same text in five words twice", "en", "x", 1),
        (5, "same text in five words twice", "en", "x", 1),
        (6, "long " * 40_000, "en", "x", 1),
        (7, "É é", "fr", "x", 1),
        (8, "é é", "fr", "x", 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    clash = df.withColumn("cls", F.lit(1)).withColumn("h1", F.lit(1)).withColumn("n", F.lit("n"))
    want = brute([(r[0], r[1]) for r in rows])
    want = sorted([(d, n, d if n == 0 else c) for d, n, c in want], key=repr)
    assert got(clash) == want
    assert got(df.limit(0)) == []
    kept = jaccard.one_of_each(clash)
    assert kept.columns == clash.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == ["1", "2", "3", "4", "5", "6", "7", "8", "None"]  # of the two rows "a b c" the one with an id stays


def test_similar_sets_share_a_page():
    """Every pair of similar sets is filed under a common page, and the bound never rejects it."""
    random = np.random.default_rng(3)
    for n in [4, 5, 7, 8, 20, 63, 64, 65, 100, 127, 128, 500, 1000, 1023, 1024, 3000]:
        for _ in range(30):
            a = np.unique(random.integers(0, 2**64, n, dtype=np.uint64))
            drop = random.integers(0, len(a) // 5 + 1)
            b = random.permutation(a)[drop:]
            room = int(len(b) / 0.8) - len(a)
            more = random.integers(0, 2**64, random.integers(0, max(room, 0) + 1), dtype=np.uint64)
            b = np.unique(np.concatenate([b, more]))
            if jaccard.similar(a, b):
                assert set(jaccard.pages(a)) & set(jaccard.pages(b))
                bits = min(jaccard.group_bits(len(a)), jaccard.group_bits(len(b)))
                bound = np.minimum(jaccard.fold(jaccard.point(a), bits), jaccard.fold(jaccard.point(b), bits)).sum()
                assert 9 * bound >= 4 * (len(a) + len(b))
                assert len(np.intersect1d(a, b)) <= bound


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 101), (101, 100), (7, 7)] + [(200, k) for k in range(201, 260)]
    out = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {i: 0 for i in range(51)} | {100: 100, 101: 100} | {k: 200 for k in range(200, 260)}
    assert {r.node: r.root for r in out} == want and len(out) == len(want)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_stars_need_no_round(spark, monkeypatch):
    staged = []
    monkeypatch.setattr(graph, "stage", lambda df, label: staged.append(label) or stage(df, label))
    edges = [(1, k) for k in range(2, 30)] + [(40, 41), (41, 40)]
    out = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in out} == {k: 1 for k in range(1, 30)} | {40: 40, 41: 40}
    assert len(staged) == 1


def test_shingles_follow_the_contract(monkeypatch):
    texts = ["", None, "a", "a b c d e f", "A b c D e", "x y z", "a a a a a a a a", "É é \x0b ü", " ", "\ttab\n", "a" * 5000]
    texts += ["one two three four five", "ONE two\x0cthree\rfour five", "w " * 3000, "é" * 900 + " x y z w v u"]
    for chunk in (1, 10, 1 << 20):
        monkeypatch.setattr(hashing, "CHUNK", chunk)
        column = pa.array(["sliced off", *texts, "end"]).slice(1, len(texts))
        sets = list(hashing.shingle_sets(column))
        assert [len(s) for s in sets] == [len(shingles(text)) for text in texts]
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                both = shingles(texts[i]) & shingles(texts[j])
                assert len(np.intersect1d(a, b)) == len(both)


def test_points_are_packed_without_loss():
    for top in (0, 1, 15, 16, 255, 256, 100_000):
        counts = np.zeros(256, dtype=np.int32)
        counts[3], counts[4], counts[255] = top, top // 2, 1
        assert (jaccard.unpacked(jaccard.packed(counts)) == counts).all()


def test_linking_pairs_join_what_the_bound_leaves():
    """Rounds of forests, with every pair refused, meet all pairs the bound leaves; without, they join the same roots."""
    random = np.random.default_rng(4)
    base = np.bincount(random.integers(0, 64, 60), minlength=64)
    points = np.array([np.bincount(random.permutation(np.repeat(np.arange(64), base))[:55], minlength=64) for _ in range(90)])
    points = points.astype(np.uint8)
    sizes, roots, side = points.sum(1).astype(int) + random.integers(0, 3, 90), random.integers(0, 70, 90), random.integers(0, 2, 90)
    for sides in (np.zeros(90, dtype=int), side):
        want = {
            (i, j)
            for i in range(90)
            for j in range(i)
            if roots[i] != roots[j]
            and (sides is not side or side[i] != side[j])
            and 100 * min(sizes[i], sizes[j]) >= 80 * max(sizes[i], sizes[j])
            and 9 * np.minimum(points[i], points[j]).sum() >= 4 * (sizes[i] + sizes[j])
        }
        assert want
        met, forests, left = set(), 1, True
        while left:
            refused = {}
            for i, j in met:
                refused.setdefault(i, []).append(j)
                refused.setdefault(j, []).append(i)
            pairs, left = jaccard.linking_pairs(points, sizes, roots, sides, refused, forests)
            pairs = {(max(p), min(p)) for p in pairs}
            assert pairs <= want - met and len(pairs) < 90 * forests
            met, forests = met | pairs, 2 * forests
        assert met == want
        once, _ = jaccard.linking_pairs(points, sizes, roots, sides)
        assert _joined(once, roots) == _joined(want, roots)


@pytest.mark.parametrize("step", [1, 1 << 20])
def test_small_pages_are_taken_many_at_once(monkeypatch, step):
    """Pages of a leaf or less make no tree each; forests, refused pairs and slices count as in larger pages."""

    def tree(points, *_):
        raise AssertionError(f"a tree over {len(points)} points")

    monkeypatch.setattr(jaccard, "linking_pairs", tree)
    monkeypatch.setattr(jaccard, "STEP", step, raising=False)
    draw = random.Random(6)
    rows, points, want, open_pages = [], {}, defaultdict(set), set()
    for page in range(120):
        two, width = page % 3 == 0, draw.choice([256, 256, 512])
        base = [draw.randrange(width) for _ in range(draw.choice([12, 300, 900]))] + [0] * draw.choice([0, 20, 300])
        members = []
        for k in range(draw.choice([1, 2, 2, 3, 5, 9, 32])):
            some = draw.sample(base, len(base) - draw.randrange(len(base) // 6 + 1))
            counts = np.bincount(some, minlength=width).astype(np.int32)
            if width == 512 and k % 2:
                counts = jaccard.fold(counts, 8)
            cls = page * 100 + k
            points[cls] = counts
            members.append([page, 0, int(two), k % 2 if two else 0, cls, len(some), page * 100 + draw.randrange(40), jaccard.packed(counts), None])
        for a in members:
            for b in members:
                bits = min(len(points[a[4]]), len(points[b[4]])).bit_length() - 1
                bound = np.minimum(jaccard.fold(points[a[4]], bits), jaccard.fold(points[b[4]], bits)).sum()
                if (
                    a[4] > b[4]
                    and a[6] != b[6]
                    and (not two or a[3] != b[3])
                    and 100 * min(a[5], b[5]) >= 80 * max(a[5], b[5])
                    and 9 * bound >= 4 * (a[5] + b[5])
                ):
                    if draw.random() < 0.1:  # told by the larger class
                        a[8] = [*(a[8] or []), b[4]]
                    else:
                        want[page].add((a[4], b[4]))
        rows += members
    assert sum(map(len, want.values())) > 1000 and any(row[8] for row in rows)
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
    names = ["page", "one", "two", "slice", "cls", "n", "root", "point", "refused"]
    table = pa.table([pa.array(values, t) for values, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
    roots = {row[4]: row[6] for row in rows}

    def taken(forests, size):
        batches = jaccard._kept_pairs(iter(table.to_batches(max_chunksize=size)), forests)
        found = [row for batch in batches for row in batch.to_pylist()]
        pairs = [(row["a"], row["b"]) for row in found if row["page"] is None]
        assert len(pairs) == len(set(pairs))
        return set(pairs), [row["page"] for row in found if row["page"] is not None]

    every = set().union(*want.values())
    assert taken(512, 100) == (every, [])
    some, left = taken(1, 1000)
    assert some < every and set(left) == {a // 100 for a, _ in every - some} and len(left) == len(set(left))
    for page in want:
        local = {c: i for i, c in enumerate(c for c in roots if c // 100 == page)}
        own = np.array([roots[c] for c in local])
        pick = [{(local[a], local[b]) for a, b in pairs if a // 100 == page} for pairs in (some, every)]
        assert _joined(pick[0], own) == _joined(pick[1], own)
        assert len(pick[0]) < len(local)


def _joined(pairs, roots):
    names = {r: r for r in roots.tolist()}

    def find(x):
        while names[x] != x:
            x = names[x]
        return x

    for i, j in pairs:
        names[find(int(roots[i]))] = find(int(roots[j]))
    groups = defaultdict(set)
    for r in names:
        groups[find(r)].add(r)
    return sorted(map(sorted, groups.values()))
