"""Quality rules: counts per document, hard limits on them, and an isolation forest over the rest.

The counts of a text are the raw material of the usual quality rules. Two hard
limits reject a document outright. All others are judged together: an isolation
forest of random splits is grown on the rates of good documents, and a document
that few splits set apart from them is odd. Splits are drawn beyond the range
of the sample, so that a value no good document has ends in an empty leaf soon.
The limit on the score is calibrated on all labelled rows of the draw, each judged
by a forest that has not seen it.

The forest is fitted on a bounded draw of labelled documents (`MOST_ROWS`) and
its size is fixed; every document is scored, whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import WORD, training_rows
from ledgerline.sources.tables import stage

MOST_ROWS = 12_000  # labelled documents drawn for the fit, about, at most
TREES = 128
SAMPLE = 256  # rows of a tree, about
LEVELS = 9
WIDER = 0.5  # a split may lie so much of the sample's range beyond it, on either side
PARTS = 4  # of the draw; the forest does not see the first, and for each other one the limit takes a forest without it
STEADY = 150  # words of a usual document mixed into every one, so that short texts do not look odd by chance
CHUNK = 4 << 20  # characters of text counted in one step; a longer text is one step of its own

LEAST_WORDS = 50
MOST_REPEATED = 50  # percent of words

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RATES = 12

_WORDS = re.compile(WORD)
_BLANK = "\x20\x09\x0a\x0b\x0c\x0d"
_SYMBOLS = "#*$%&|<>"  # fixed values of the rule


def repeated_words(words: list[str]) -> int:
    """Words that lie in a window of three words which the text holds twice or more."""
    n = len(words)
    if n < 4:
        return 0
    index: dict[str, int] = {}
    ids = np.fromiter((index.setdefault(word, len(index)) for word in words), dtype=np.int64, count=n)
    pairs = ids[:-1] * len(index) + ids[1:]
    if len(index) > 1 << 20:  # keeps the next product within 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, which, counts = np.unique(pairs[:-1] * len(index) + ids[2:], return_inverse=True, return_counts=True)
    again = counts[which] > 1
    covered = np.zeros(n, dtype=bool)
    for k in range(3):
        covered[k : n - 2 + k] |= again
    return int(covered.sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The counts of a whole text, and the rates the forest sees."""
    words = _WORDS.findall(text) if text else []
    if not words:
        return [0, 0, sum(map(text.count, _SYMBOLS)) if text else 0, 0, 0], [0.0] * RATES
    n = len(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    lines = [line for line in text.split("\n") if line.strip(_BLANK)]
    symbols = sum(map(text.count, _SYMBOLS))
    same = len(lines) - len(set(lines))
    again = repeated_words(words)
    chars = int(lengths.sum())
    ends = sum(map(str.isalnum, [word[-1] for word in words]))
    rates = [
        symbols / n,
        chars / n,
        float(lengths.std()),
        same / len(lines),
        again / n,
        sum(map(str.isupper, words)) / n,
        sum(map(text.count, "!?")) / n,
        sum(map(text.count, ".,;:")) / n,
        1 - ends / n,
        np.log1p(n / len(lines)),
        float((lengths == 1).sum()) / n,
        sum(map(text.count, "0123456789")) / chars,
    ]
    return [n, chars, symbols, same, again], rates


def base_failed(counts: np.ndarray) -> np.ndarray:
    n, again = counts[:, 0], counts[:, 4]
    return (n < LEAST_WORDS) | (100 * again > MOST_REPEATED * n)


def steadied(n_words: np.ndarray, rates: np.ndarray, usual: np.ndarray) -> np.ndarray:
    weight = (n_words / (n_words + STEADY))[:, None]
    return weight * rates + (1 - weight) * usual


def _usual_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of a search that ends without a hit in a random tree of n rows."""
    n = np.asarray(n, dtype=float)
    m = np.maximum(n, 3)
    long = 2 * (np.log(m - 1) + np.euler_gamma) - 2 * (m - 1) / m
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


def grown(rows: np.ndarray, random: np.random.Generator) -> list[tuple[int, float, float]]:
    """A tree as a heap of `LEVELS` levels: (column, limit, path length); a leaf has column -1.

    A leaf holds the path length of a row that ends there.
    """
    nodes = [(-1, 0.0, 0.0)] * ((2 << LEVELS) - 1)
    open_ = [(0, 0, rows)]
    while open_:
        at, level, part = open_.pop()
        low, high = (part.min(0), part.max(0)) if len(part) else (np.zeros(RATES), np.zeros(RATES))
        spread = np.flatnonzero(high > low)
        if level == LEVELS or len(part) < 2 or not len(spread):
            nodes[at] = (-1, 0.0, level + float(_usual_path(len(part))))
            continue
        column = int(random.choice(spread))
        wide = WIDER * (high[column] - low[column])
        limit = float(random.uniform(low[column] - wide, high[column] + wide))
        nodes[at] = (column, limit, 0.0)
        left = part[:, column] < limit
        open_ += [(2 * at + 1, level + 1, part[left]), (2 * at + 2, level + 1, part[~left])]
    return nodes


@dataclass
class Forest:
    """Trees as heaps in one array each; the size is fixed by the parameters."""

    column: np.ndarray
    limit: np.ndarray
    length: np.ndarray
    usual: np.ndarray
    limit_of_score: float

    def scores(self, n_words: np.ndarray, rates: np.ndarray) -> np.ndarray:
        """Between 0 and 1, higher for rows that are set apart sooner."""
        rates = steadied(n_words, rates, self.usual)
        total = np.zeros(len(rates))
        every = np.arange(len(rates))
        for column, limit, length in zip(self.column, self.limit, self.length, strict=True):
            at = np.zeros(len(rates), dtype=np.int64)
            for _ in range(LEVELS):
                split = column[at]
                right = rates[every, split] >= limit[at]
                at = np.where(split < 0, at, 2 * at + 1 + right)
            total += length[at]
        return 2.0 ** -(total / len(self.column) / float(_usual_path(SAMPLE)))


def best_limit(scores: np.ndarray, good: np.ndarray) -> float:
    """The limit with the fewest labelled rows on the wrong side, in the middle of the widest such gap.

    A limit of 1 keeps every row, also those that score 1.
    """
    order = np.argsort(scores, kind="stable")
    scores, good = scores[order], good[order]
    lost = good.sum() - np.concatenate([[0], np.cumsum(good)])  # good rows above a cut before row i
    kept = np.concatenate([[0], np.cumsum(~good)])  # bad rows below it
    edges = np.concatenate([[0.0], scores, [1.0]])
    between = np.diff(edges) > 0
    between[-1] = True
    wrong = np.where(between, lost + kept, len(scores) + 1)
    best = np.flatnonzero(wrong == wrong.min())
    cut = best[np.argmax(np.diff(edges)[best])]
    below, above = float(edges[cut]), float(edges[cut + 1])
    middle = (below + above) / 2
    return middle if middle < above else below  # nothing lies between neighbouring numbers


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [statistics(text) for text in batch.column("text").to_pylist()]
        counts = np.array([c for c, _ in found], dtype=np.int64).reshape(-1, len(COUNTS))
        rates = pa.array([r for _, r in found], pa.list_(pa.float64()))
        failed = pa.array(base_failed(counts))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), batch.column("part"), failed, pa.array(counts[:, 0]), rates],
            ["doc_id", "label", "part", "failed", "n_words", "rates"],
        )


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", seed: int = 11) -> Forest | None:
    """A forest over good documents and its limit, from a bounded draw of labelled rows.

    Rows that fail the hard limits take no part. The forest grows on three of
    four parts of the good rows. All good and bad rows set the limit: good ones
    that the forest has seen are judged by one grown alike without their part.
    Without bad rows, or without good ones to grow and to judge, there is
    nothing to calibrate; None is returned, and the hard limits alone decide.
    """
    drawn = training_rows(docs, labels, target, MOST_ROWS).select("doc_id", "text", "label", "part")
    schema = "doc_id long, label int, part int, failed boolean, n_words long, rates array<double>"
    rows = stage(drawn.mapInArrow(_counted, schema), "rules-drawn").filter("not failed")
    growing = rows.filter("label = 1")
    known = [F.when(F.col("part") != without, F.col("rates")) for without in range(PARTS)]
    sums = growing.agg(*[F.count(seen) for seen in known], *[F.avg(seen[i]) for seen in known for i in range(RATES)]).first()
    usual = np.array([0.0 if mean is None else mean for mean in sums[PARTS:]]).reshape(PARTS, RATES)
    shares = F.array(*[F.lit(min(1.0, SAMPLE / max(1, n)) * (1 << 30)) for n in sums[:PARTS]])

    trees = growing.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(PARTS * TREES - 1))))
    trees = trees.withColumn("without", F.floor(F.col("tree") / TREES).cast("int")).filter(
        (F.col("part") != F.col("without"))
        & (F.pmod(F.xxhash64("doc_id", "tree"), F.lit(1 << 30)) < F.get(shares, F.col("without")))
    )

    def grow(part: pd.DataFrame) -> pd.DataFrame:
        tree = int(part["tree"].iloc[0])
        sample = steadied(part["n_words"].to_numpy(), np.stack(part["rates"].to_numpy()), usual[tree // TREES])
        sample = sample[np.lexsort(sample.T)]  # the same tree whatever the order of the rows
        nodes = grown(sample, np.random.default_rng([seed, tree]))
        return pd.DataFrame({"tree": [tree], "nodes": [[float(value) for node in nodes for value in node]]})

    grown_trees = trees.select("tree", "n_words", "rates").groupBy("tree").applyInPandas(grow, "tree int, nodes array<double>")
    found = [[] for _ in range(PARTS)]
    for row in grown_trees.orderBy("tree").collect():  # rows of fixed size, TREES a forest
        found[row.tree // TREES].append(np.array(row.nodes).reshape(-1, 3))
    rest = rows.select("label", "part", "n_words", "rates").collect()  # at most the draw
    forests = [None] * PARTS
    for without, nodes in enumerate(found):
        if nodes:
            packed = np.array(nodes)
            forests[without] = Forest(packed[:, :, 0].astype(np.int64), packed[:, :, 1], packed[:, :, 2], usual[without], 1.0)
    forest = forests[0]
    if forest is None:
        return None
    scores, good = [], []
    for without, judge in enumerate(forests):
        own = [row for row in rest if (row.part == without if row.label == 1 else without == 0)]
        if own and judge is not None:
            scores.append(judge.scores(np.array([row.n_words for row in own]), np.array([row.rates for row in own])))
            good += [row.label == 1 for row in own]
    good = np.array(good, dtype=bool)
    if good.all() or not good.any():
        return None
    forest.limit_of_score = best_limit(np.concatenate(scores), good)
    return forest


def judged(docs: DataFrame, forest: Forest | None) -> DataFrame:
    """doc_id, the counts, base_failed, odd_score and kept of every row.

    Reads doc_id and text; other columns may have any name. A missing, empty or
    blank text has no words and fails; its symbols count all the same. Repeated
    rows and equal texts get equal results, rows without an id are judged like
    all others. A score at the limit is kept. Texts of any length are counted
    whole, a bounded number of characters at a time beside the longest text.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                found = [statistics(text) for text in part.column("text").to_pylist()]
                counts = np.array([c for c, _ in found], dtype=np.int64).reshape(-1, len(COUNTS))
                failed = base_failed(counts)
                rates = np.array([r for _, r in found], dtype=float).reshape(-1, RATES)
                scores = np.zeros(len(found)) if forest is None else forest.scores(counts[:, 0], rates)
                odd = scores > (1.0 if forest is None else forest.limit_of_score)
                columns = [part.column("doc_id"), *[pa.array(counts[:, i]) for i in range(len(COUNTS))]]
                columns += [pa.array(failed), pa.array(scores), pa.array(~failed & ~odd)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *COUNTS, "base_failed", "odd_score", "kept"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = ", ".join(f"{name} long" for name in COUNTS)
    return slim.mapInArrow(judge, f"doc_id long, {counts}, base_failed boolean, odd_score double, kept boolean")


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about `CHUNK` bytes of text."""
    sizes = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, before + CHUNK, "right")))
        yield batch.slice(start, end - start)
        start = end
