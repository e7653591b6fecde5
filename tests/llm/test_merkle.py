import hashlib
import random
import zlib

import pytest

from ledgerline.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, `index` int"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(doc_id, text, lang, source, n_chars):
    return h("".join(map(field, (doc_id, source, lang, n_chars, text))))


def levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def path(tree, i):
    """(before, after) of the node and its ancestors."""
    out = []
    for level in tree[:-1]:
        start = i - i % 16
        run = level[start : start + 16]
        out.append(("".join(run[: i - start]), "".join(run[i - start + 1 :])))
        i //= 16
    return out


def brute(rows):
    """Rows of (doc_id, leaf, subroot, root, proof, folded, verified)."""
    lower = str.maketrans(merkle.UPPER, merkle.LOWER)
    by_source = {}
    for row in rows:
        by_source.setdefault(row[3], []).append(row)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    ordered = {s: sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r[:5]))) for s in sources}
    trees = {s: levels([leaf(*r[:5]) for r in ordered[s]]) for s in sources}
    top = levels([trees[s][-1][0] for s in sources])
    out = []
    for place, s in enumerate(sources):
        for i, r in enumerate(ordered[s]):
            text = r[1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and text is not None:
                text = text.translate(lower)
            folded = leaf(r[0], text, *r[2:5])
            steps = path(trees[s], i) + path(top, place)
            for before, after in steps:
                folded = h(before + folded + after)
            root = top[-1][0]
            out.append(
                (r[0], leaf(*r[:5]), trees[s][-1][0], root, h("".join(b + a for b, a in steps)), folded, folded == root)
            )
    return sorted(out, key=repr)


def got(spark, rows):
    docs = spark.createDataFrame([(*r, "mine", 1) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in merkle.proofs(docs).collect()), key=repr)


def some(n, source, seed):
    draw = random.Random(seed)
    return [
        (i * 3, "".join(draw.choices("aB cÉ\n", k=draw.randrange(0, 40))), "en", source, draw.randrange(100))
        for i in range(n)
    ]


@pytest.mark.parametrize("n", [1, 2, 16, 17, 33, 257])
def test_place_is_completion_order(n):
    leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    counts = merkle.sizes(n)
    log = merkle.completed(leaves, len(counts) - 1)
    tree = levels([x.hex() for x in leaves])
    assert len(log) == sum(counts)
    for level, nodes in enumerate(tree):
        for index, digest in enumerate(nodes):
            assert log[merkle.place(level, index, counts)].hex() == digest


def test_edges_against_brute_force(spark):
    rows = some(40, "a", 1) + some(1, "é", 2) + some(17, "z", 3) + some(16, "Z", 4)
    rows += [
        (None, None, None, None, None),
        (None, "X", "en", None, 1),
        (7, "", "de", None, 0),
        (7, "", "de", None, 0),
        (7, "SAME id", "de", "a", 0),
        (10**15, "LONG " * 60_000, "en", "", 5),
        (-4, "Below", None, "z", None),
    ]
    assert got(spark, rows) == brute(rows)


def test_one_row_and_none(spark):
    assert got(spark, [(5, "A", "en", "s", 1)]) == brute([(5, "A", "en", "s", 1)])
    assert got(spark, []) == []


def test_several_rounds(spark, monkeypatch):
    """A source of two blocks beside small ones: 4,096 rows and a few more, and many sources."""
    rows = [r for i in range(20) for r in some(2, f"s{i:02}", i)] + some(merkle.BLOCK + 40, "big", 9)
    assert got(spark, rows) == brute(rows)


def test_log_is_whole(spark):
    rows = some(merkle.BLOCK + 300, "big", 9) + some(20, "small", 2)
    docs = spark.createDataFrame([(*r, "mine", 1) for r in rows], SCHEMA)
    found = {}
    for r in merkle.log(docs).collect():
        found.setdefault(r.tree, []).append((r.position, r.level, r["index"], r.digest))
    for tree, source in ((0, "big"), (1, "small")):
        want = levels([leaf(*r) for r in sorted((r for r in rows if r[3] == source), key=lambda r: r[0])])
        nodes = sorted(found[tree])
        assert [n[0] for n in nodes] == list(range(sum(map(len, want))))
        assert all(want[level][index] == digest for _, level, index, digest in nodes)
