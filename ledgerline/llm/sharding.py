"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered from 0 in the order (id, checksum, size); the numbers are
permuted by a keyed Feistel network over a * b >= n cells, walking the cycle
until a cell below n is met. Position p goes to shard p % shards at slot
p // shards, so shard and slot of any row number, and the row number at any
shard and slot, can be computed without the data.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.ordering import cut, positions
from ledgerline.sources.tables import stage

ROUNDS = 6
WALK = 6  # steps of the cycle walk written out before the rare longer walk


def cells(rows: int) -> tuple[int, int]:
    """Sides a, b of the smallest near-square domain of at least `rows` cells; a * b - rows < a."""
    a = max(1, math.isqrt(rows))
    return a, max(1, -(-rows // a))


def _draw(seed: int, turn: int, value: int) -> int:
    return int(hashlib.md5(f"{seed}:{turn}:{value}".encode()).hexdigest()[:15], 16)


def _once(x: int, a: int, b: int, seed: int, back: bool) -> int:
    left, right = x // b, x % b
    sign = -1 if back else 1
    for turn in reversed(range(ROUNDS)) if back else range(ROUNDS):
        if turn % 2 == 0:
            left = (left + sign * _draw(seed, turn, right)) % a
        else:
            right = (right + sign * _draw(seed, turn, left)) % b
    return left * b + right


def locate(row: int, rows: int, shards: int, seed: int) -> tuple[int, int]:
    """Shard and slot of a row number."""
    a, b = cells(rows)
    x = _once(row, a, b, seed, False)
    while x >= rows:
        x = _once(x, a, b, seed, False)
    return x % shards, x // shards


def row_at(shard: int, slot: int, rows: int, shards: int, seed: int) -> int:
    """The row number at a shard and slot; the inverse of `locate`."""
    a, b = cells(rows)
    x = _once(slot * shards + shard, a, b, seed, True)
    while x >= rows:
        x = _once(x, a, b, seed, True)
    return x


def permuted(row: str, rows: int, seed: int) -> Column:
    """The permuted position of a row number column, in built-in functions only.

    The walk is written out for a few steps. At most about sqrt(rows) rows need
    a second step and hardly any a third; the last branch walks as long as any
    cycle can be (a * b - rows cells lie outside), so no row is left over.
    """
    a, b = cells(rows)

    def drawn(value: str) -> str:
        text = f"concat({seed}, ':', t, ':', {value})"
        return f"cast(conv(substring(md5({text}), 1, 15), 16, 10) as bigint)"

    def once(x: str) -> str:
        start = f"named_struct('l', {x} div {b}L, 'r', {x} % {b}L)"
        left = f"named_struct('l', (s.l + {drawn('s.r')}) % {a}L, 'r', s.r)"
        right = f"named_struct('l', s.l, 'r', (s.r + {drawn('s.l')}) % {b}L)"
        turns = f"sequence(0, {ROUNDS - 1})"
        return f"aggregate({turns}, {start}, (s, t) -> if(t % 2 = 0, {left}, {right}), s -> s.l * {b}L + s.r)"

    def walked(x: str, steps: int) -> str:
        return f"aggregate(sequence(1, {steps}), {x}, (x, i) -> if(x < {rows}L, x, {once('x')}))"

    outside = a * b - rows
    first = once(f"cast({row} as bigint)")
    if not outside:
        return F.expr(first)
    near = f"if(y < {rows}L, y, {walked('y', min(outside, WALK))})"
    far = f"if(y < {rows}L, y, {walked('y', outside)})"
    step = f"element_at(transform(array({first}), y -> {near}), 1)"
    return F.expr(step if outside <= WALK else f"element_at(transform(array({step}), y -> {far}), 1)")


def shard_rows(docs: DataFrame, shards: int, seed: int) -> DataFrame:
    """Shard and slot of every row of `docs` (`doc_id`, `text`; other columns are not read).

    Returns doc_id, size (UTF-8 bytes of the text plus 1), text_crc32, law,
    shard, slot, grown_shard. The law is `rows`: shard sizes differ by at most
    one. Missing ids sort first; a missing text has no bytes and checksum 0.
    Rows equal in id, checksum and size are interchangeable: each gets its own
    slot, and the set of results is the same on every run. An empty table gives
    an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = stage(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.monotonically_increasing_id().alias("_tie"),
        ),
        "shard-slim",
    )
    order = ["doc_id", "text_crc32", "size", "_tie"]
    rows = slim.count()
    numbered = positions(cut(slim, order, "shard-cut"), order)
    placed = numbered.withColumn("_at", permuted("_row", max(rows, 1), seed))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        (F.col("_at") % shards).cast("int").alias("shard"),
        F.floor(F.col("_at") / F.lit(shards)).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
