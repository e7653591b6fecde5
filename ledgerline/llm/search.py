"""Exact top-k search by inner product with a pivot-distance index.

One more component turns the largest inner product into the smallest distance:
with M the largest norm, v becomes (v, sqrt(M^2 - |v|^2)) and a query (q, 0), so
that |q' - v'|^2 = |q|^2 + M^2 - 2 q.v. Every vector is keyed by its nearest
pivot and its distance to it; the distances of a pivot are cut into annuli. By
the triangle inequality a vector of annulus [lo, hi] around p is at least
max(d(q, p) - hi, lo - d(q, p)) away from q, which bounds its score. A query
expands its annuli from the best bound on: the first ones give a k-th score,
and all others whose bound lies below it are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.sources.tables import stage

PIVOTS = 8
RINGS = 8
SAMPLE = 2_000  # vectors from which pivots and ring borders are fitted; every vector is indexed
CHUNK = 8_192  # vectors of an annulus that meet in one task
QUERIES = 4_096  # queries that meet them there
FIRST = 64  # candidates per wanted result in the annuli of the first wave


def usable(vector: Column) -> Column:
    """Neither missing nor holding a missing or non-finite component."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & good, F.lit(False))


def scaled(vector: Column, factor: float = 256.0) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(factor)).cast("long"))


class Index:
    """Pivots and ring borders in the space of one more component; of fixed size."""

    def __init__(self, sample: np.ndarray, top: float, pivots: int, rings: int, seed: int) -> None:
        self.top, self.rings = top, rings
        points = self.lift(sample)
        random = np.random.default_rng(seed)
        centres = points[random.choice(len(points), min(pivots, len(points)), replace=False)]
        for _ in range(8):
            near = self._far(points, centres).argmin(1)
            centres = np.array([points[near == i].mean(0) if (near == i).any() else c for i, c in enumerate(centres)])
        self.pivots = centres
        far = self._far(points, centres)
        near = far.argmin(1)
        shares = np.arange(1, rings) / rings
        self.borders = np.array(
            [np.quantile(far[near == i, i], shares) if (near == i).any() else np.zeros(rings - 1) for i in range(len(centres))]
        )

    def lift(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.top - (vectors * vectors).sum(1), 0.0))
        return np.hstack([vectors, rest[:, None]])

    @staticmethod
    def _far(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
        return np.sqrt(np.stack([((points - c) ** 2).sum(1) for c in centres], 1))

    def place(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell (pivot and ring) and pivot distance of each vector."""
        far = self._far(self.lift(vectors), self.pivots)
        near = far.argmin(1)
        dist = far[np.arange(len(far)), near]
        ring = (self.borders[near] < dist[:, None]).sum(1)
        return near * self.rings + ring, dist

    def bounds(self, queries: np.ndarray, cells: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The highest score a vector of each cell can have with each query, with room for rounding."""
        flat = np.hstack([queries, np.zeros((len(queries), 1))])
        d = self._far(flat, self.pivots)[:, cells // self.rings]
        gap = np.maximum(np.maximum(d - high, low - d), 0.0)
        norm = (queries * queries).sum(1)[:, None] + self.top
        gap = np.maximum(gap - 1e-9 * np.sqrt(norm), 0.0)
        return (norm - gap * gap) / 2 + 1 + 1e-9 * norm


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        places = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))][:k]


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.int64)


def _inner(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact integer inner products, in floating point where that is exact."""
    top = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * queries.shape[1]
    if top < 2**53:
        return (queries.astype(float) @ vectors.astype(float).T).astype(np.int64)
    return queries @ vectors.T


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, pivots: int = PIVOTS, rings: int = RINGS, seed: int = 3
) -> DataFrame:
    """The `k` highest inner products of every query vector over all others.

    `vectors` has `vec_id` and `vector` (array of long); other columns are not
    read. Rows without an id or a vector take no part. Shorter vectors count as
    filled up with zeros. Every row is a candidate, repeated ones included,
    except those of the query's own id; a repeated query row is answered as
    often as it occurs. Returns query_id, rank (from 1), vec_id, score. An empty
    table, or one without queries, gives an empty result. Products beyond 64
    bits wrap around.
    """
    spark = vectors.sparkSession
    rows = stage(
        vectors.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("vector").cast("array<long>").alias("vector"),
            F.coalesce(is_query, F.lit(False)).alias("asks"),
            F.monotonically_increasing_id().alias("row"),
        ).filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()),
        "search-rows",
    )
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    facts = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.size("vector")).alias("width"),
        F.max(squares).alias("top"),
        F.count_if("asks").alias("asking"),
    ).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not facts.n or not facts.asking:
        return empty
    width = max(1, facts.width)
    fill = F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("vector"))
    rows = rows.withColumn("vector", F.concat("vector", fill))
    share = min(1.0, SAMPLE / facts.n)
    drawn = rows.filter(F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    sample = [row.vector for row in drawn.select("vector").limit(2 * SAMPLE).collect()]
    sample = sample or [row.vector for row in rows.select("vector").limit(1).collect()]
    index = Index(np.array(sample, dtype=float), float(facts.top), pivots, rings, seed)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                cell, dist = index.place(_stack(batch["vector"]).astype(float))
                yield batch.assign(cell=cell.astype(np.int32), dist=dist)

    schema = "vec_id long, vector array<long>, asks boolean, row long, cell int, dist double"
    stored = stage(rows.mapInPandas(place, schema), "search-index")
    found = stored.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.min("dist").alias("low"), F.max("dist").alias("high")
    )
    found = found.orderBy("cell").collect()  # at most pivots * rings rows
    cells = np.array([row.cell for row in found])
    sizes, low, high = (np.array([row[name] for row in found]) for name in ("n", "low", "high"))
    parts = -(-sizes // CHUNK)
    blocks = -(-facts.asking // QUERIES)

    def wave(first: bool):
        """Query rows, once for each annulus of the wave."""

        def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if not len(batch):
                    continue
                bound = index.bounds(_stack(batch["vector"]).astype(float), cells, low, high)
                order = np.argsort(-bound, axis=1, kind="stable")
                before = np.cumsum(sizes[order], axis=1) - sizes[order]
                near = np.empty(bound.shape, dtype=bool)
                np.put_along_axis(near, order, before < FIRST * k, axis=1)
                wanted = near if first else ~near & (bound >= batch["least"].to_numpy(float)[:, None])
                which, at = np.nonzero(wanted)
                for s in range(0, len(which), 5_000):
                    part = batch.iloc[which[s : s + 5_000]]
                    yield part[["vec_id", "vector", "row"]].assign(
                        cell=cells[at[s : s + 5_000]], parts=parts[at[s : s + 5_000]]
                    )

        return emit

    def scores(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(candidates):
            ids, data = candidates["vec_id"].to_numpy(), _stack(candidates["vector"])
            asked, who, own = _stack(queries["vector"]), queries["row"].to_numpy(), queries["vec_id"].to_numpy()
            for s in range(0, len(asked), 256):
                products = _inner(asked[s : s + 256], data)
                for i, line in enumerate(products, s):
                    others = np.flatnonzero(ids != own[i])
                    places = others[best(line[others], ids[others], k)] if len(others) else others
                    out.append(
                        pd.DataFrame(
                            {"row": who[i], "query_id": own[i], "vec_id": ids[places], "score": line[places]}
                        )
                    )
        return pd.concat(out) if out else pd.DataFrame({"row": [], "query_id": [], "vec_id": [], "score": []}, dtype="int64")

    def met(asking: DataFrame, first: bool) -> DataFrame:
        """Each query's best candidates of each part of the annuli it reads in this wave."""
        kept = "vec_id long, vector array<long>, row long, cell int, parts int"
        block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block")
        part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
        questions = asking.mapInPandas(wave(first), kept).select("vec_id", "vector", "row", "cell", block, part)
        count = F.element_at(
            F.create_map(*[F.lit(int(x)) for pair in zip(cells, parts, strict=True) for x in pair]), F.col("cell")
        )
        answers = stored.select(
            "vec_id",
            "vector",
            "cell",
            F.pmod(F.xxhash64("row"), count).cast("int").alias("part"),
            F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        )
        key = ["cell", "part", "block"]
        return questions.groupBy(*key).cogroup(answers.groupBy(*key)).applyInPandas(
            scores, "row long, query_id long, vec_id long, score long"
        )

    ranked = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    asking = stored.filter("asks").select("vec_id", "vector", "row")
    near = stage(met(asking, True), "search-near")
    least = (
        near.withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") == k)
        .select("row", F.col("score").cast("double").alias("least"))
    )
    rest = asking.join(least, "row", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
    return (
        near.unionByName(met(rest, False))
        .withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
