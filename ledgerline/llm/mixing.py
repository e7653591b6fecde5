"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern, the set of sources they belong
to. A network routes the patterns' words to the sources' quotas: a pattern
offers its words once at no cost, a second time at cost 1, and so on, so that
repetition costs grow convexly. Since costs lie only on the arcs that leave the
start, shortest augmenting paths come in order of repetition, and the min-cost
flow is a series of maximum flows in which one more repetition is opened each
time. The flow of a pattern then selects its documents in a seeded order.

What reaches the driver is one row per source and per pattern, never one per
document; a corpus with more than `MAX_PATTERNS` distinct patterns is refused.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import word_count
from ledgerline.operators.ordering import cut, positions
from ledgerline.sources.tables import stage

MAX_PATTERNS = 200_000
MISSING = "~"  # the missing source, after all named ones, which start with "="


def source_key(source: Column) -> Column:
    """A name for each source, in code point order, the missing source last."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(MISSING))


def targets(sizes: dict[str, int], weights: Sequence[float], share: float, most: float) -> dict[str, float]:
    """Words wanted of each source.

    Sources in order take the weights in turn and share `share` times all words.
    A target above `most` times its source's size is cut to that, and the excess
    is shared again among the others by weight until none is above.
    """
    names = sorted(sizes)
    weight = {name: weights[i % len(weights)] for i, name in enumerate(names)}
    left, open_names, wanted = float(share * sum(sizes.values())), names, {}
    while open_names:
        whole = sum(weight[name] for name in open_names)
        offer = {name: left * weight[name] / whole for name in open_names}
        over = [name for name in open_names if offer[name] > most * sizes[name]]
        if not over:
            return wanted | offer
        for name in over:
            wanted[name] = float(most * sizes[name])
            left -= wanted[name]
        open_names = [name for name in open_names if name not in wanted]
    return wanted


def route(patterns: dict[tuple[str, ...], int], quotas: dict[str, int], repeats: int) -> dict[tuple[str, ...], int]:
    """Words that a min-cost flow takes of each pattern, repetitions counted."""
    names = list(patterns)
    members = {s: [p for p in range(len(names)) if s in names[p]] for s in quotas}
    sent: dict[tuple[int, str], int] = {}
    taken = [0] * len(names)
    left = dict(quotas)

    def augment(limit: int) -> bool:
        """Push along one shortest path from a pattern with words left to a source with quota left."""
        before: dict[object, object] = {p: None for p in range(len(names)) if taken[p] < limit * patterns[names[p]]}
        queue: deque[object] = deque(before)
        while queue:
            at = queue.popleft()
            if isinstance(at, int):
                for s in names[at]:
                    if s in quotas and s not in before:
                        before[s] = at
                        if left[s] > 0:
                            return push(s, before, limit)
                        queue.append(s)
            else:
                for p in members[at]:
                    if p not in before and sent.get((p, at), 0) > 0:
                        before[p] = at
                        queue.append(p)
        return False

    def push(end: str, before: dict, limit: int) -> bool:
        path, at = [end], end
        while before[at] is not None:
            at = before[at]
            path.append(at)
        path.reverse()  # pattern, source, pattern, ..., source
        room = min(left[end], limit * patterns[names[path[0]]] - taken[path[0]])
        for k in range(1, len(path) - 1, 2):
            room = min(room, sent[path[k + 1], path[k]])
        for k in range(0, len(path) - 1, 2):
            sent[path[k], path[k + 1]] = sent.get((path[k], path[k + 1]), 0) + room
            if k + 2 < len(path):
                sent[path[k + 2], path[k + 1]] -= room
        taken[path[0]] += room
        left[end] -= room
        return True

    for limit in range(1, repeats + 1):  # opening a repetition after all cheaper flow keeps the cost minimal
        while augment(limit):
            pass
    return dict(zip(names, taken, strict=True))


def _keyed(docs: DataFrame, members: Column, seed: int) -> DataFrame:
    sources = F.array_sort(F.array_distinct(members))
    return docs.withColumn("_members", F.coalesce(sources, F.array().cast("array<string>"))).withColumn(
        "_draw", F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), F.xxhash64("text"))
    )


_PLAN = pa.schema(
    [
        ("members", pa.list_(pa.string())),
        ("_rank", pa.int32()),
        ("_start", pa.int64()),
        ("_whole", pa.int64()),
        ("_rest", pa.int64()),
        ("source_size", pa.int64()),
        ("target", pa.float64()),
    ]
)


def _table(plan: list[tuple]) -> pa.Table:
    return pa.Table.from_pylist([dict(zip(_PLAN.names, row, strict=True)) for row in plan], schema=_PLAN)


def mix(
    docs: DataFrame,
    members: Column,
    seed: int = 17,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    repeats: int = 2,
) -> DataFrame:
    """Copies of each document in a mix that meets the sources' targets.

    `members` is an array of source keys per row (`source_key`). A row's size is
    the number of words of `text`. Returns doc_id, members, size, copies, taken
    (copies * size), source_size and target of the first member, and the draw
    that orders the documents of a pattern. Whole documents are taken: the last
    one of a pattern is taken if that brings the words nearer to the flow. No
    document is taken more than `repeats` times.

    A missing text has size 0; rows of size 0 and rows without members add no
    words (copies of the former follow their pattern, of the latter are 0). Rows
    with equal id, text and members are interchangeable; the mix is the same on
    every run. Only `doc_id`, `text` and the columns of `members` are read. An
    empty table gives an empty result.
    """
    slim = stage(
        _keyed(docs, members, seed).select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("_members").alias("members"),
            word_count(F.col("text")).alias("size"),
            F.col("_draw").alias("draw"),
            F.monotonically_increasing_id().alias("_tie"),
        ),
        "mix-slim",
    )
    found = slim.groupBy("members").agg(F.sum("size").alias("words")).limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    patterns = {tuple(row.members): int(row.words) for row in found}
    sizes: dict[str, int] = {}
    for pattern, words in patterns.items():
        for name in pattern:
            sizes[name] = sizes.get(name, 0) + words
    wanted = targets(sizes, weights, share, repeats)
    flow = route(patterns, {name: round(value) for name, value in wanted.items()}, repeats)

    plan, passed = [], 0
    for rank, pattern in enumerate(sorted(patterns)):
        words = patterns[pattern]
        whole, rest = divmod(flow[pattern], words) if words else (0, 0)
        first = pattern[0] if pattern else None
        plan.append((list(pattern), rank, passed, whole, rest, sizes.get(first), wanted.get(first)))
        passed += words
    # at most MAX_PATTERNS rows; as an Arrow table they start no Python workers on the executors
    lookup = F.broadcast(slim.sparkSession.createDataFrame(_table(plan)))

    order = ["_rank", "draw", "doc_id", "_tie"]
    ranked = slim.join(lookup.select("members", "_rank"), "members").drop("members")
    placed = positions(cut(ranked, order, "mix-cut"), order, F.col("size")).join(lookup, "_rank")
    inside = F.col("_before") - F.col("_start")
    extra = (F.col("_rest") > 0) & (2 * inside + F.col("size") <= 2 * F.col("_rest"))
    copies = F.col("_whole") + extra.cast("long")
    return placed.select(
        "doc_id",
        "members",
        "size",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
        "source_size",
        "target",
        "draw",
    )


def take_mix(docs: DataFrame, members: Column, seed: int = 17, **options) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it, with all its columns.

    The mix is told by two numbers per pattern, so the texts are not moved: the
    copies of every document and the last draw that gets one more. Rows equal in
    id, text and members have one draw and are taken alike, as often as the mix
    takes the most taken of them.
    """
    mixed = mix(docs, members, seed, **options)
    fewest = F.min("copies").alias("_few")
    each = mixed.groupBy("members").agg(fewest, F.max("copies").alias("_many"))
    last = (
        mixed.join(F.broadcast(each), "members")  # one row per pattern
        .groupBy("members", "_few", "_many")
        .agg(F.max(F.when(F.col("copies") == F.col("_many"), F.col("draw"))).alias("_last"))
    )
    rule = F.broadcast(stage(last, "mix-rule").withColumnRenamed("members", "_members"))
    names = [F.col(f"`{name}`") for name in docs.columns]
    copies = F.when(F.col("_draw") <= F.col("_last"), F.col("_many")).otherwise(F.col("_few")).cast("int")
    return (
        _keyed(docs, members, seed)
        .select(F.struct(*names).alias("_row"), "_members", "_draw")
        .join(rule, "_members")
        .withColumn("_copies", copies)
        .filter(F.col("_copies") > 0)
        .select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .select("_row.*")
    )
