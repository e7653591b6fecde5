import random
import re
import zlib
from collections import Counter

import pytest

from ledgerline.llm import spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (x != y))
    return row[-1]


def counted(rows):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {word: n for word, n in out.items() if len(word) >= 5 and n >= 3}


def brute(words):
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and edits(v, w) == 1] for w in words}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[word] = best if best is not None and words[best] >= 2 * words[word] else None
    out = []
    for word, n in words.items():
        root = word
        while form[root]:
            root = form[root]
        out.append((word, form[word], root, n, len(near[word]), words.get(form[word])))
    return sorted(out, key=repr)


def got(spark, rows):
    docs = spark.createDataFrame([(i, t, "mine", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    return sorted((tuple(r) for r in spelling.variants(docs).collect()), key=repr)


def corpus(seed, size=60, letters="abé"):
    draw = random.Random(seed)
    words = ["".join(draw.choices(letters, k=draw.randrange(4, 9))) for _ in range(size)]
    return [(i, " ".join(draw.choices(words, weights=range(1, size + 1), k=40))) for i in range(120)]


@pytest.mark.parametrize("rows", [40_000, 50])
def test_against_brute_force(spark, monkeypatch, rows):
    """With parts of 50 rows, groups go on over parts and words visit other parts."""
    monkeypatch.setattr(spelling, "PART_ROWS", rows)
    docs = corpus(1) + corpus(2, 300, "abcdefgh")
    assert got(spark, docs) == brute(counted(docs))


def test_one_long_half_for_all(spark, monkeypatch):
    """All words share a long first half, and all their last half: two groups hold everything."""
    monkeypatch.setattr(spelling, "PART_ROWS", 20)
    monkeypatch.setattr(spelling, "QUERIES_AT_ONCE", 7)
    draw = random.Random(5)
    words = ["".join(["prefix", *draw.choices("ab", k=6)]) for _ in range(60)]
    words += ["".join([*draw.choices("ab", k=6), "suffix"]) for _ in range(60)]
    docs = [(i, " ".join(words)) for i in range(3)]
    assert got(spark, docs) == brute(counted(docs))


def test_edges(spark):
    long = "x" * 30_000
    docs = [(None, "Words words WORDS wordz"), (1, None), (2, ""), (3, "   \n"), (4, "wordz wordz É×÷ÿé"), (5, "ÉÉÉÉÉ éÉÉÉÉ ÉÉÉÉÉ")]
    docs += [(5, "ÉÉÉÉÉ éÉÉÉÉ éÉÉÉÉ"), (6, f"{long} {long}y {long} {long}y")] * 3 + [(7, "tied1tieda tiedb tied_ tieda tiedb tieda tiedb tiedc " * 3)] * 2
    assert got(spark, docs) == brute_long(docs)
    assert got(spark, []) == []


def brute_long(docs):
    """As `brute`; words too long for the plain matrix are told apart by their one more letter."""
    words = counted(docs)
    long = sorted((w for w in words if len(w) > 1_000), key=len)
    out = brute({w: n for w, n in words.items() if len(w) <= 1_000})
    assert len(long) in (0, 2) and all(words[w] == words[long[0]] for w in long)
    return sorted(out + [(w, None, w, words[w], 1, None) for w in long], key=repr)


def test_chain_of_forms(spark):
    """Each word is half as frequent as the next one: roots are reached by several jumps."""
    words = ["aaaaaa"]
    for i in range(6):
        words.append(words[-1][:i] + "b" + words[-1][i + 1 :])
    docs = [(None, " ".join([word] * 2 ** (i + 2))) for i, word in enumerate(words)]
    result = got(spark, docs)
    assert result == brute(counted(docs))
    assert sum(r[2] != r[0] for r in result) >= 5


def test_scan_against_all_pairs():
    draw = random.Random(8)
    words = sorted({"pre" + "".join(draw.choices("ab", k=draw.randrange(0, 7))) for _ in range(80)})
    asked = words + ["pre" + "".join(draw.choices("abc", k=draw.randrange(0, 7))) for _ in range(40)]
    found = {(q, p) for qs, ps in spelling.scan([(words, 3)], asked, [0] * len(asked)) for q, p in zip(qs, ps)}
    assert found == {(i, j) for i, q in enumerate(asked) for j, w in enumerate(words) if edits(q, w) <= 1}


def test_prefixes():
    for prefix, word, want in [
        ("abc", "abcdef", True),
        ("abx", "abcdef", True),
        ("axx", "abcdef", False),
        ("bcd", "abcdef", True),
        ("abcdefg", "abcdef", True),
        ("abcdefgh", "abcdef", False),
        ("", "a", True),
    ]:
        assert spelling.within_one_edit_of_prefix(prefix, word) == want
