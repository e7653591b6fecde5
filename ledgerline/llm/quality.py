"""Quality scores: a Gaussian kernel machine over document statistics.

Random Fourier features approximate the kernel, so ridge regression needs only
the normal equations, which are summed per partition and then over partitions.
An isotonic fit on rows the ridge has not seen turns its output into a
probability.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import WORD, training_rows
from ledgerline.sources.tables import stage

MOST_ROWS = 20_000  # labelled documents drawn for training, about, at most
FEATURES = 192
RIDGE = 1e-3
GAMMA = 0.03  # of the kernel exp(-gamma * squared distance) over standardised statistics

_WORDS = re.compile(WORD)
_SYMBOLS = [
    np.frombuffer(group, dtype=np.uint8)
    for group in (b"!", b"#$%&*+<=>@\\^_`~", b"|/", b".,;:?", b"'\"()[]{}-")
]
STATISTICS = 22


def statistics(text: str | None) -> np.ndarray:
    """Statistics of a whole text; all zero for an empty or missing one."""
    out = np.zeros(STATISTICS)
    words = _WORDS.findall(text) if text else []
    if not words:
        return out
    data = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    counts = np.bincount(data, minlength=256)
    chars, n = len(text), len(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    kinds = Counter(words)
    often = max(kinds.values())
    lines = [line for line in text.split("\n") if line.strip()]
    per_line = Counter(lines)
    upper, lower = counts[65:91].sum(), counts[97:123].sum()
    out[:11] = (
        np.log1p(chars),
        np.log1p(n),
        lengths.mean(),
        lengths.std(),
        upper / max(1, upper + lower),
        counts[48:58].sum() / chars,
        counts[192:].sum() / chars,
        len(kinds) / n,
        np.log1p(n / len(kinds)),
        often / n,
        sum(map(str.__eq__, words, words[1:])) / n,
    )
    out[11:16] = [counts[group].sum() / chars for group in _SYMBOLS]
    out[16:] = (
        1 - len(per_line) / max(1, len(lines)),
        np.log1p(n / max(1, len(lines))),
        sum(map(str.isupper, words)) / n,
        (lengths == 1).sum() / n,
        sum(1 for word in words if not word[-1].isalnum()) / n,
        sum(1 for line in lines if line.rstrip()[-1] in ".!?") / max(1, len(lines)),
    )
    return out


def statistics_of(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([statistics(text).tolist() for text in texts])

    return compute(text)


@dataclass
class Model:
    """Everything that scoring needs; its size does not depend on the data."""

    centre: np.ndarray
    scale: np.ndarray
    turn: np.ndarray
    shift: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    levels: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        scaled = np.clip((stats - self.centre) / self.scale, -6, 6)
        waves = np.sqrt(2 / len(self.shift)) * np.cos(scaled @ self.turn + self.shift)
        return np.hstack([waves, np.ones((len(stats), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated probability; within a level the raw order is kept by a thousandth."""
        raw = self.raw(stats)
        fitted = np.interp(raw, self.steps, self.levels)
        return np.clip(0.999 * fitted + 0.001 * np.clip(raw, 0, 1), 0.0, 1.0)


def _summed(rows: DataFrame, terms) -> dict[int, float]:
    """Sums over all rows of the vector `terms(statistics, labels)`, first in each partition."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                part = terms(np.stack(batch["stats"].to_numpy()), batch["label"].to_numpy(float))
                total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"place": np.arange(len(total)), "value": total})

    sums = rows.mapInPandas(partial, "place long, value double").groupBy("place").agg(F.sum("value").alias("value"))
    return {row.place: row.value for row in sums.collect()}  # as many as the vector has places


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", seed: int = 7) -> Model | float:
    """A model of `target` from a bounded draw of labelled documents.

    Three quarters of them fit the ridge, one quarter the calibration. With
    fewer than two classes there is nothing to fit; the share of label 1 (0.5
    without labels) is returned and becomes the score of every document.
    """
    drawn = training_rows(docs, labels, target, MOST_ROWS)
    rows = stage(drawn.select("label", "part", statistics_of(F.col("text")).alias("stats")), "quality-train")
    counts = {row.label: row["count"] for row in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        return float(next(iter(counts), 0.5))
    fitting = rows.filter("part > 0").select("stats", "label")

    def moments(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])

    sums = _summed(fitting, moments)
    n = max(1.0, sums.get(0, 1.0))
    centre = np.array([sums.get(1 + i, 0.0) for i in range(STATISTICS)]) / n
    square = np.array([sums.get(1 + STATISTICS + i, 1.0) for i in range(STATISTICS)]) / n
    random = np.random.default_rng(seed)
    model = Model(
        centre,
        np.sqrt(np.maximum(square - centre**2, 1e-8)),
        random.normal(0.0, np.sqrt(2 * GAMMA), (STATISTICS, FEATURES)),
        random.uniform(0.0, 2 * np.pi, FEATURES),
        np.zeros(FEATURES + 1),
        np.array([0.0, 1.0]),
        np.array([0.0, 1.0]),
    )

    wide = FEATURES + 1
    places = np.triu_indices(wide)

    def equations(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = model.features(x)
        return np.concatenate([(z.T @ z)[places], z.T @ y])

    sums = _summed(fitting, equations)
    flat = np.array([sums.get(i, 0.0) for i in range(len(places[0]) + wide)])
    gram = np.zeros((wide, wide))
    gram[places] = flat[: len(places[0])]
    gram = gram + np.triu(gram, 1).T
    model.weights = np.linalg.solve(gram + RIDGE * n * np.eye(wide), flat[len(places[0]) :])

    @F.pandas_udf("double")
    def raw(stats: pd.Series) -> pd.Series:
        return pd.Series(model.raw(np.stack(stats.to_numpy())) if len(stats) else [], dtype=float)

    unseen = rows.filter("part = 0").select(raw("stats").alias("raw"), F.col("label").cast("double"))
    levelled = unseen.select("label", array_to_vector(F.array("raw")).alias("raw"))
    if unseen.count():
        isotonic = IsotonicRegression(featuresCol="raw", labelCol="label").fit(levelled)
        model.steps = np.array(isotonic.boundaries.toArray())
        model.levels = np.array(isotonic.predictions.toArray())
    return model


def score_of(text: Column, model: Model | float) -> Column:
    """The score of a text column; a missing or empty text has all statistics zero and a score like any other."""
    if isinstance(model, float):
        return F.lit(model)

    @F.pandas_udf("double")
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            if len(texts):
                yield pd.Series(model.score(np.stack([statistics(text) for text in texts])))
            else:
                yield pd.Series([], dtype=float)

    return compute(text)
