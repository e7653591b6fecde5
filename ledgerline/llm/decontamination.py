"""Benchmark decontamination: item-sized windows of documents that match a benchmark item.

A window of as many words as the item is compared by its five-word shingles with
their counts as weights: similarity is the sum of the smaller over the sum of
the larger counts. Candidates come from 64-bit SimHash fingerprints of the
windows. Eight blocks of eight bits, each looked up with up to two bits changed,
meet every fingerprint within `RADIUS` = 23 bits: with more than two differing
bits in each block there would be 24. At a similarity of 0.8 about ten bits
differ, so that limit is over four standard deviations away.

A window at that similarity has at least 8 of 9 of its shingles in common with
the item (a text shorter than the item 4 of 5 of the item's). A bit table of all (length, shingle) pairs of the benchmark tells which
windows can have that many; only those are fingerprinted. The table has a fixed
size; a larger benchmark only lets more windows through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import WordHashes, mix, shingle_hashes
from ledgerline.sources.tables import stage

LENGTH = 5
SIMILARITY = 0.8
RADIUS = 23
BLOCKS = 8
BITS = 22  # of the bit tables: half a megabyte each

_WORDS = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    """Words as runs of letters and digits in lower case, so that marks and line breaks do not hide a passage."""
    return _WORDS.findall(text.lower()) if text else []


def enough(shingles: int, short: bool = False) -> int:
    """Shingles of an item of so many that a window as long as it (or a shorter text) must have for the similarity."""
    return -(-4 * shingles // 5) if short else -(-8 * shingles // 9)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of the smaller over sum of the larger counts of two bags of shingles."""
    kinds, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    one = np.bincount(place[: len(a)], minlength=len(kinds))
    two = np.bincount(place[len(a) :], minlength=len(kinds))
    return float(np.minimum(one, two).sum() / np.maximum(one, two).sum())


def fingerprints(shingles: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the `size` shingles from each start on."""
    base = int(starts.min())
    used = shingles[base : int(starts.max()) + size]
    bits = ((used[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.int32)
    sums = np.vstack([np.zeros((1, 64), dtype=np.int32), np.cumsum(bits, axis=0)])
    ones = sums[starts - base + size] - sums[starts - base]
    return ((2 * ones > size).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(1, dtype=np.uint64)


def _slot(shingles: np.ndarray, words: int) -> np.ndarray:
    return (mix(shingles ^ np.uint64(words * 2 + 1)) >> np.uint64(64 - BITS)).astype(np.int64)


def _items(items: DataFrame, unnamed: bool) -> DataFrame:
    """Words, fingerprint, shingles and bit table slots of each item with words.

    With `unnamed`, items of five words or more that have no id get a hash of their text as one.
    """

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        with np.errstate(over="ignore"):
            for batch in batches:
                out = []
                for item_id, named, text in zip(batch["item_id"], batch["named"], batch["text"], strict=True):
                    words = words_of(text)
                    if words and (named or len(words) >= LENGTH):
                        s = shingle_hashes(hashes(words), LENGTH)
                        print_ = fingerprints(s, np.zeros(1, dtype=np.int64), len(s)).view(np.int64)[0]
                        slots = np.concatenate([_slot(s, len(words)), _slot(s, 0)])
                        out.append((item_id, len(words), print_, s.tobytes(), slots))
                yield pd.DataFrame(out, columns=["item_id", "words", "print", "shingles", "slots"])

    schema = "item_id long, words int, print long, shingles binary, slots array<long>"
    item_id = F.col("item_id").cast("long")
    read = items.select(
        F.coalesce(item_id, F.xxhash64("text")).alias("item_id"), item_id.isNotNull().alias("named"), "text"
    )
    read = read if unnamed else read.filter("named")
    return stage(read.mapInPandas(made, schema), "decontamination-items")


def _windows(docs: DataFrame, lengths: list[int], table: np.ndarray) -> DataFrame:
    """Fingerprinted windows that can match an item of their length."""
    least = min(enough(max(1, w - LENGTH + 1), True) for w in lengths)

    def of_text(words: np.ndarray) -> Iterator[tuple[int, int, int, bytes]]:
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for length in {min(LENGTH, w) for w in lengths}:
            if len(words) >= length:
                s = shingle_hashes(words, length)
                at = np.flatnonzero(table[_slot(s, 0)])
                if len(at) >= least:
                    found[length] = (s, at)
        for w in lengths:
            length = min(LENGTH, w)
            if length not in found:
                continue
            s, at = found[length]
            size = w - length + 1
            hits = at[table[_slot(s[at], w)]]
            need = enough(size, len(s) < size)
            if len(hits) < need:
                continue
            last = max(0, len(s) - size)  # a shorter text is one window as a whole
            runs = hits[: len(hits) - need + 1], hits[need - 1 :]  # `need` hits in a row within `size` shingles
            near = runs[1] - runs[0] < size
            starts = np.unique(
                np.concatenate(
                    [np.arange(max(0, b - size + 1), min(last, a) + 1) for a, b in zip(*(r[near] for r in runs))]
                    or [np.empty(0, dtype=np.int64)]
                )
            ).astype(np.int64)
            if len(starts):
                size = min(size, len(s))
                for start, print_ in zip(starts, fingerprints(s, starts, size), strict=True):
                    yield int(start), w, int(print_.astype(np.int64)), s[start : start + size].tobytes()

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        with np.errstate(over="ignore"):
            for batch in batches:
                rows, index = [], []
                for i, text in enumerate(batch.column("text").to_pylist()):
                    for row in of_text(hashes(words_of(text))):
                        index.append(i)
                        rows.append(row)
                if rows:
                    kept = batch.select(["doc_id", "h1", "h2"]).take(pa.array(index, pa.int64()))
                    made_columns = [
                        pa.array(values, kind)
                        for values, kind in zip(
                            zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int64(), pa.binary()), strict=True
                        )
                    ]
                    names = ["doc_id", "h1", "h2", "start", "words", "print", "window"]
                    yield pa.RecordBatch.from_arrays([*kept.columns, *made_columns], names)

    schema = "doc_id long, h1 long, h2 long, start int, words int, print long, window binary"
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), *_text_hashes(), "text"
    ).mapInArrow(made, schema)


def _text_hashes() -> list[Column]:
    return [F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), F.col("text")).alias("h2")]


def _blocks(fingerprint: Column) -> Column:
    """(block, value) of the eight blocks of a fingerprint."""
    values = [F.shiftrightunsigned(fingerprint, 8 * b).bitwiseAND(F.lit(255)) for b in range(BLOCKS)]
    return F.array(*[F.struct(F.lit(b).alias("block"), v.cast("int").alias("value")) for b, v in enumerate(values)])


def matches(docs: DataFrame, items: DataFrame, unnamed: bool = False) -> DataFrame:
    """Pairs of documents and benchmark items that match, one row per pair.

    Reads `doc_id` and `text`, and `item_id` and `text`; other columns may have
    any name. Returns doc_id, item_id, similarity, start (of the best window, the
    earliest of equal ones, in shingles), words (of the item), h1 and h2 (hashes
    of the text). Items without words match nothing, nor do texts without
    words. Items without an id match nothing either, or with `unnamed`, if they
    have five words or more, under a hash of their text. A text shorter than the item is one window. Items of fewer than five
    words must occur as a whole. Repeated rows give one row; documents without
    an id are reported with a null one. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    known = _items(items, unnamed)
    lengths = [row.words for row in known.select("words").distinct().orderBy("words").collect()]
    schema = "doc_id long, item_id long, similarity double, start int, words int, h1 long, h2 long"
    if not lengths:
        return spark.createDataFrame([], schema)
    table = np.zeros(1 << BITS, dtype=bool)
    slots = known.select(F.explode("slots").alias("slot")).distinct()
    table[[row.slot for row in slots.collect()]] = True  # at most 2 ** BITS of them

    windows = stage(_windows(docs, lengths, table), "decontamination-windows")
    near = [0] + [1 << i for i in range(8)] + [1 << i | 1 << j for i in range(8) for j in range(i)]
    filed = known.select("item_id", "words", F.col("print").alias("theirs"), F.explode(_blocks(F.col("print"))).alias("at"))
    filed = filed.select(
        "item_id",
        "words",
        "theirs",
        F.col("at.block").alias("block"),
        F.explode(F.transform(F.lit(near), lambda d: F.col("at.value").bitwiseXOR(d))).alias("value"),
    )
    asked = windows.select("doc_id", "h1", "h2", "start", "words", "print", F.explode(_blocks(F.col("print"))).alias("at"))
    asked = asked.select("doc_id", "h1", "h2", "start", "words", "print", "at.block", "at.value")
    apart = F.bit_count(F.col("print").bitwiseXOR(F.col("theirs")))
    pairs = (
        asked.join(filed, ["words", "block", "value"])
        .filter(apart <= RADIUS)
        .select("doc_id", "h1", "h2", "start", "words", "item_id")
        .distinct()
    )

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                similarity(np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64))
                for a, b in zip(batch["window"], batch["shingles"], strict=True)
            ]
            batch = batch.assign(similarity=np.array(found, dtype=float))
            yield batch.loc[batch["similarity"] >= SIMILARITY - 1e-12, names]

    names = ["doc_id", "item_id", "similarity", "start", "words", "h1", "h2"]
    whole = windows.select("h1", "h2", "start", "words", "window").dropDuplicates(["h1", "h2", "start", "words"])
    held = pairs.join(whole, ["h1", "h2", "start", "words"]).join(known.select("item_id", "shingles"), "item_id")
    good = held.select("doc_id", "item_id", "start", "words", "h1", "h2", "window", "shingles").mapInPandas(verify, schema)
    best = F.max_by(F.struct("similarity", "start", "words", "h1", "h2"), F.struct("similarity", -F.col("start")))
    return good.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*")


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """`docs` without the documents that match an item; rows and columns are otherwise as they were.

    Items without an id count too if they have five words or more.
    """
    texts = F.col("_row.text")
    bad = stage(matches(docs, items, unnamed=True).select("h1", "h2").distinct(), "decontamination-matches")
    rows = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_row"))
    rows = rows.withColumns({"h1": F.xxhash64(texts), "h2": F.xxhash64(F.lit(1), texts)})
    return rows.join(bad, ["h1", "h2"], "left_anti").select("_row.*")
