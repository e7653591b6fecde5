"""Toxicity scores: gradient-boosted trees over dense features, calibrated.

The features are densities of two lexicons (a given list, and words and word
beginnings that the training rows show to go with label 1), how near lexicon words stand to words
of the second person, capitals, punctuation and obfuscation rates. The trees
and the isotonic calibration see different labelled rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import training_rows
from ledgerline.sources.tables import stage

MOST_ROWS = 12_000  # labelled documents drawn for training, about, at most
MOST_LEARNT = 400  # entries of the learnt lexicon
STEMS = (4, 5, 6, 7)  # word beginnings of these lengths can be entries, too, as "stem*"
TREES = 25
DEPTH = 3
PARTS = (1, 2, 3)  # of the training rows, for the lexicon and the trees; part 0 calibrates
LEAST = 3  # documents of label 1 that an entry of the learnt lexicon must occur in
LEAST_Z = 2.5
NEAR = 5  # words between a lexicon word and a second-person word
SPAN = 50  # words of the window in which lexicon words are counted at their densest

INSULTS = """
abject abomination arse awful bastard brainless clown clueless coward cretin creep degenerate despicable
disgrace disgusting dumb dunce filth filthy fool freak garbage halfwit hate hateful idiot idiotic imbecile
incompetent inferior jerk kill lame liar loathsome loser lowlife lunatic maggot moron moronic nasty nitwit
parasite pathetic pig pitiful rat repulsive ridiculous rotten rubbish scum scumbag shameful sicken slime
stupid subhuman swine thug trash twit ugly useless vermin vile weakling worm worthless wretch
abruti connard crétin débile dégoûtant imbécile minable ordure pourri sale stupide
abschaum blöd dreck dumm dummkopf ekelhaft erbärmlich idiotisch trottel wertlos widerlich
asco asqueroso basura cretino estúpido imbécil inútil patético tonto
""".split()
SECOND_PERSON = """
you your yours yourself yourselves u ur youre tu te toi ton ta tes vous votre vos du dich dir dein deine
deinen ihr euch euer tú ti tus usted ustedes vosotros vuestro
""".split()

_TOKENS = re.compile(r"[^\W_]+(?:[0-9@$!*+.\-_][^\W_]+)*")
_PLAIN = str.maketrans("0134578@$!", "oieastbasi", "*+.-_")
_MARKS = re.compile(r"[@$!*+.\-_]+")
_SPACED = re.compile(r"(?<!\w)(?:\w[ .\-_*]){3,}\w(?!\w)")
FEATURES = 19


def plain_form(token: str) -> str:
    """A token with the usual stand-ins for letters put back and separators left out."""
    return token.translate(_PLAIN)


class Features:
    """The feature vector of a text, for a given pair of lexicons."""

    def __init__(self, learnt: Mapping[str, float], insults: Sequence[str] = INSULTS) -> None:
        self.learnt, self.insults = dict(learnt), frozenset(insults)
        self.second = frozenset(SECOND_PERSON)
        self.strong = max(self.learnt.values(), default=1.0) / 2
        self._known: dict[str, float] = {}

    def _weight(self, word: str) -> float:
        """The strongest entry of the learnt lexicon that a word or its beginning meets; 0 for none."""
        known = self._known.get(word)
        if known is None:
            if len(self._known) > 300_000:
                self._known.clear()
            entries = [word, *(word[:n] + "*" for n in STEMS if len(word) > n)]
            known = self._known[word] = max(self.learnt.get(entry, 0.0) for entry in entries)
        return known

    def __call__(self, text: str | None) -> list[float]:
        if not text:
            return [0.0] * FEATURES
        tokens = _TOKENS.findall(text)
        low = [token.lower() for token in tokens]
        n = max(1, len(low))
        given = [i for i, word in enumerate(low) if word in self.insults]
        weights = [self._weight(word) for word in low]
        shown = [i for i, weight in enumerate(weights) if weight >= self.strong]
        hidden = odd = 0
        for i, word in enumerate(low):
            if not word.isalpha() and not word.isdigit() and not word[0].isdigit():
                form = plain_form(word)
                odd += form != word
                if form.isalpha() and (form in self.insults or form in self.learnt):
                    hidden += 1
                    given.append(i)
                else:
                    pieces = set(_MARKS.split(word))
                    given += [i] * bool(pieces & self.insults)
                    shown += [i] * any(self._weight(piece) >= self.strong for piece in pieces)
        for spaced in _SPACED.findall(text):
            form = re.sub(r"[ .\-_*]", "", spaced).lower()
            hidden += form in self.insults or form in self.learnt
        hits = np.unique(np.array(given + shown, dtype=np.int64))
        second = np.array([i for i, word in enumerate(low) if word in self.second], dtype=np.int64)
        near = densest = 0
        if len(hits):
            densest = int((np.searchsorted(hits, hits + SPAN) - np.arange(len(hits))).max())
            if len(second):
                near = int((np.searchsorted(second, hits + NEAR, "right") > np.searchsorted(second, hits - NEAR)).sum())
        counts = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8), minlength=256)
        upper, lower, chars = int(counts[65:91].sum()), int(counts[97:123].sum()), len(text)
        punctuation = int(counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum())
        return [
            100.0 * len(given) / n,
            float(np.log1p(len(given))),
            100.0 * len(shown) / n,
            float(np.log1p(len(shown))),
            100.0 * sum(weights) / n / (2 * self.strong),
            100.0 * sum(1 for weight in weights if weight > 0) / n,
            float(len({low[i] for i in given + shown})),
            near / max(1, len(hits)),
            100.0 * near / n,
            100.0 * len(second) / n,
            float(densest),
            upper / max(1, upper + lower),
            sum(1 for token in tokens if len(token) > 2 and token.isupper()) / n,
            100.0 * float(counts[33]) / chars,
            100.0 * float(counts[63]) / chars,
            100.0 * punctuation / chars,
            100.0 * odd / n,
            float(hidden),
            float(np.log1p(len(low))),
        ]

    def of(self, text: Column) -> Column:
        @F.pandas_udf("array<double>")
        def compute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                yield pd.Series([self(text) for text in texts])

        return compute(text)


def _entries(rows: DataFrame) -> DataFrame:
    """Documents with each word and stem, by part, in all and of label 1; entries in fewer than `LEAST` of these are left out."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1)))

    def stems(n: int) -> Column:
        longer = F.filter(words, lambda word: F.length(word) > n)
        return F.array_distinct(F.transform(longer, lambda word: F.concat(F.substring(word, 1, n), F.lit("*"))))

    entries = rows.select("label", "part", F.explode(F.concat(words, *[stems(n) for n in STEMS])).alias("word"))
    sums = [F.sum(F.when(F.col("part") == p, F.col("label"))).alias(f"with{p}") for p in PARTS]
    sums += [F.count_if(F.col("part") == p).alias(f"all{p}") for p in PARTS]
    return stage(entries.groupBy("word").agg(F.sum("label").alias("with"), *sums).filter(F.col("with") >= LEAST), "toxicity-words")


def learnt_words(entries: DataFrame, sizes: dict[tuple[int, int], int], parts: Sequence[int]) -> dict[str, float]:
    """Entries that occur in far more documents of label 1 than their share, with their z-scores, by the given parts.

    `sizes` has the number of rows of each (part, label).
    """
    ones, zeros = (sum(sizes.get((p, label), 0) for p in parts) for label in (1, 0))
    high = sum((F.coalesce(f"with{p}", F.lit(0)) for p in parts), F.lit(0))
    low = sum((F.col(f"all{p}") for p in parts), F.lit(0)) - high
    odds = F.log((high + 0.5) / (ones + 1.0)) - F.log((low + 0.5) / (zeros + 1.0))
    z = odds / F.sqrt(1 / (high + 0.5) + 1 / (low + 0.5))
    strong = entries.filter(high >= LEAST).withColumn("z", z).filter((F.col("z") > LEAST_Z) & (odds > 1.5))
    best = strong.orderBy(F.desc("z"), "word").limit(MOST_LEARNT)
    return {row.word: row.z for row in best.select("word", "z").collect()}


class Model:
    """A fitted scorer; without two classes in the training rows, a constant."""

    def __init__(
        self,
        features: Features,
        trees: GBTClassificationModel | None = None,
        levels: IsotonicRegressionModel | None = None,
        constant: float = 0.5,
    ) -> None:
        self.features, self.trees, self.levels, self.constant = features, trees, levels, constant

    def scored(self, docs: DataFrame) -> DataFrame:
        """`docs` with `score`, which replaces a column of that name; other columns may have any name.

        An empty or missing text has all features zero and a score like any
        other. Equal texts have equal scores, so repeated rows do, too. An empty
        table gives an empty result.
        """
        others = [name for name in docs.columns if name.lower() != "score"]
        if self.trees is None:
            return docs.select(*[F.col(f"`{name}`") for name in others], F.lit(self.constant).alias("score"))
        # the caller's columns stay apart from those that the trees and levels add
        row = F.struct(*[F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(others)]).alias("_row")
        raw = _raw(self.trees, docs.select(row, array_to_vector(self.features.of(F.col("text"))).alias("_features")))
        if self.levels is None:
            found, score = raw, F.col("_raw")
        else:
            # within a level the order of the trees is kept by a thousandth
            found, score = self.levels.transform(raw), 0.999 * F.col("_level") + 0.001 * F.col("_raw")
            score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), score))
        return found.select(*[F.col(f"_row.c{i}").alias(name) for i, name in enumerate(others)], score.alias("score"))


def _raw(trees: GBTClassificationModel, vectors: DataFrame) -> DataFrame:
    return trees.transform(vectors).withColumn("_raw", vector_to_array("_chance")[1])


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic", insults: Sequence[str] = INSULTS) -> Model:
    """A model of `target` from a bounded draw of labelled documents.

    Three quarters of them give the learnt lexicon and the trees. The trees see
    each of these parts through a lexicon learnt from the other two, so that
    they do not trust it more than it holds for new documents. The last quarter
    gives the calibration.
    """
    rows = stage(training_rows(docs, labels, target, MOST_ROWS), "toxicity-rows")
    sizes = {(row.part, row.label): row["count"] for row in rows.groupBy("part", "label").count().collect()}
    entries = _entries(rows.filter("part > 0"))
    features = Features(learnt_words(entries, sizes, PARTS), insults)
    made = None
    for part in (0, *PARTS):
        others = [p for p in PARTS if p != part]
        lens = Features(learnt_words(entries, sizes, others), insults) if part else features
        one = rows.filter(F.col("part") == part).select("label", "part", lens.of(F.col("text")).alias("features"))
        made = one if made is None else made.unionByName(one)
    made = stage(made, "toxicity-train").select(
        "part", F.col("label").cast("double").alias("label"), array_to_vector("features").alias("_features")
    )
    seen, unseen = made.filter("part > 0").coalesce(4), made.filter("part = 0").coalesce(4)
    kinds = {row.label for row in seen.select("label").distinct().collect()}
    if len(kinds) < 2:
        return Model(features, constant=float(next(iter(kinds), 0.5)))
    learner = GBTClassifier(
        featuresCol="_features", labelCol="label", predictionCol="_class", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=11
    )
    trees = learner.setProbabilityCol("_chance").setRawPredictionCol("_margin").fit(seen)
    checked = _raw(trees, unseen)
    levels = None
    if unseen.count():
        levels = IsotonicRegression(featuresCol="_raw", labelCol="label", predictionCol="_level").fit(checked)
    return Model(features, trees, levels)
