import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm import queries, rules

DATA = "/root/testdata/sf0.1"


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    again = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    seen, same = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            same += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), same, len(again)]


EDGES = [
    None,
    "",
    " \t\r\n\x0b\x0c",
    "# *",
    "a b c",
    "a b c a b c",
    "a a a a",
    "é É x | <b>&amp;</b>  y",
    "line one\nline one\n line one\nline one\r\n\n\n",
    "x " * 40_000 + "y " * 3,
    "A b C\nA b C\n" * 30,
    " ".join(map(str, range(49))),
    " ".join(map(str, range(50))),
]


def test_counts_against_brute_force(spark):
    draw = random.Random(3)
    texts = EDGES + [" ".join(draw.choices("ab*c d\n", k=draw.randrange(200))) for _ in range(300)]
    docs = spark.createDataFrame(
        [(i if i % 7 else None, text, 1, "other") for i, text in enumerate(texts)],
        "doc_id long, text string, kept int, n_words string",
    )
    got = sorted((tuple(r[:6]) for r in rules.judged(docs.repartition(3), None).collect()), key=repr)
    assert got == sorted(((i if i % 7 else None, *brute(text)) for i, text in enumerate(texts)), key=repr)
    for row in rules.judged(docs, None).collect():
        assert row.base_failed == (row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words)
        assert row.kept == (not row.base_failed)


def test_many_different_words():
    words = [str(i % 1_200_000) for i in range(1_300_000)]
    assert rules.repeated_words(words) == 200_000


def test_query(spark):
    rows = queries.QUERIES["op12_quality_rules"](spark, DATA).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert all(list(r[1:6]) == brute(texts[r.doc_id]) for r in rows)
    assert not any(r.kept and r.base_failed for r in rows)
    unseen = [
        (r.kept, labels[r.doc_id])
        for r in rows
        if r.doc_id in labels and not r.base_failed and zlib.crc32(str(r.doc_id).encode()) % 3 == 1
    ]
    assert np.mean([kept for kept, label in unseen if label == 1]) > 0.97
    assert np.mean([kept for kept, label in unseen if label == 0]) < 0.05


def test_tree_is_a_partition():
    random_ = np.random.default_rng(1)
    rows = random_.normal(size=(300, rules.RATES))
    nodes = rules.grown(rows, random_)
    ends = Counter()
    for row in rows:
        at, depth = 0, 0
        while nodes[at][0] >= 0:
            column, limit, _ = nodes[at]
            at, depth = 2 * at + 1 + int(row[column] >= limit), depth + 1
        ends[at] += 1
        assert depth <= rules.LEVELS
    for at, n in ends.items():
        depth = (at + 1).bit_length() - 1
        assert nodes[at][2] == pytest.approx(depth + float(rules._usual_path(n)))


def test_scores_against_one_row_at_a_time():
    random_ = np.random.default_rng(2)
    trees = [rules.grown(random_.normal(size=(50, rules.RATES)), random_) for _ in range(5)]
    packed = np.array(trees)
    forest = rules.Forest(packed[:, :, 0].astype(int), packed[:, :, 1], packed[:, :, 2], np.zeros(rules.RATES), 0.5)
    rows, n = random_.normal(size=(20, rules.RATES)) * 2, random_.integers(1, 900, 20)
    for i, score in enumerate(forest.scores(n, rows)):
        row, total = rows[i] * n[i] / (n[i] + rules.STEADY), 0.0
        for nodes in trees:
            at = 0
            while nodes[at][0] >= 0:
                at = 2 * at + 1 + int(row[nodes[at][0]] >= nodes[at][1])
            total += nodes[at][2]
        assert score == pytest.approx(2 ** -(total / 5 / float(rules._usual_path(rules.SAMPLE))))


def test_best_limit():
    scores, good = np.array([0.1, 0.2, 0.3, 0.6, 0.8]), np.array([True, True, True, False, False])
    assert rules.best_limit(scores, good) == pytest.approx(0.45)
    assert 0.3 < rules.best_limit(np.array([0.3, 0.3, 0.3, 0.9]), np.array([True, True, False, False])) < 0.9


def test_best_limit_at_the_ends():
    assert rules.best_limit(np.array([1.0, 1.0]), np.array([True, True])) == 1.0
    low, high = 1 - 2**-53, 1 - 2**-52
    limit = rules.best_limit(np.array([high, low]), np.array([True, False]))
    assert high <= limit < low


def test_all_labelled_rows_set_the_limit(spark, monkeypatch):
    """Good rows that are all in one half of the draw's parts, none held back, and every row counts once."""
    parts = spark.range(400).selectExpr("id", "cast(pmod(xxhash64(id, 'part'), 4) as int) as part", "pmod(crc32(cast(cast(id as string) as binary)), 3) = 1 as held")
    ids = [(r.id, r.part) for r in parts.orderBy("id").collect() if not r.held]
    good = [i for i, part in ids if part in (1, 2)][:40]
    bad = [i for i, _ in ids if i not in good][:10]
    draw = random.Random(5)
    texts = [(i, " ".join(f"{draw.choice('abcde')}{draw.randrange(99)}x" for _ in range(120))) for i in good]
    texts += [(i, " ".join(f"#{draw.randrange(9999)}!?" for _ in range(120))) for i in bad]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in good] + [(i, 0) for i in bad], "doc_id long, quality int")
    counted, limit_of = [], rules.best_limit
    monkeypatch.setattr(rules, "best_limit", lambda scores, good: counted.append(good) or limit_of(scores, good))
    forest = rules.fit(docs, labels)
    assert forest is not None
    assert counted[0].sum() == len(good) and (~counted[0]).sum() == len(bad)
    kept = {r.doc_id for r in rules.judged(docs, forest).collect() if r.kept}
    assert kept == set(good)


def test_one_label_or_none(spark):
    docs = spark.createDataFrame([(1, "a b " * 60), (2, None)], "doc_id long, text string")
    for rows in ([], [(1, 1, 0)], [(1, None, 0)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
        assert rules.fit(docs, labels) is None
    assert rules.judged(docs.limit(0), None).collect() == []
