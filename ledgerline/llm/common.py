"""What several operators share: tables, words, training labels."""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of a text: a run of anything but space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
_WORDS = re.compile(WORD)
#: Of a batch of rows that goes to Python, about; a longer row is a batch of its own.
BATCH_BYTES = 1 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """From now on Arrow batches of the session go by bytes, too, unless it bounds them itself.

    By rows alone a batch holds 10,000 texts however long they are, as buffers
    in the JVM that double while they grow, and as copies in the Python worker.
    """
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words_of(text: str | None) -> list[str]:
    """Words with A-Z in lower case; none for a missing text."""
    return _WORDS.findall(text.translate(_ASCII_LOWER)) if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit mixing of unsigned integers (multiply and shift)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """64-bit hashes of words. The memory of past words is emptied when it grows past `most`."""

    def __init__(self, most: int = 500_000) -> None:
        self._known: dict[str, int] = {}
        self._most = most

    def __call__(self, words: list[str]) -> np.ndarray:
        if len(self._known) > self._most:
            self._known.clear()
        known = self._known
        for word in set(words).difference(known):
            known[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


_TURN = [np.uint64(pow(0x9E3779B97F4A7C15, k, 1 << 64)) for k in range(1, 17)]


def shingle_hashes(hashes: np.ndarray, length: int = 5) -> np.ndarray:
    """One hash per run of `length` words; a shorter text is one run as a whole."""
    n = len(hashes)
    if n == 0:
        return np.empty(0, dtype=np.uint64)
    length = min(length, n)
    total = np.full(n - length + 1, length, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(length):
            total += hashes[k : n - length + 1 + k] * _TURN[k]
        return mix(total)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from: crc32(doc_id as text) mod 3 is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, target: str, most: int) -> DataFrame:
    """doc_id, text, label and part of about `most` labelled documents at most, drawn by a hash of the id.

    Held-out rows are never drawn. Several labels of one document are averaged
    and rounded; missing ids or labels are left out. `part` (0 to 3) is a second
    draw, for parts that must not see each other. The drawn ids are broadcast:
    their number is bounded by `most`, whatever the size of the tables.
    """
    known = (
        labels.filter(F.col(target).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.round(F.avg(target)).cast("int").alias("label"))
    )
    share = min(1.0, 0.95 * most / max(1, known.count()))
    drawn = known.filter(F.pmod(F.xxhash64("doc_id", F.lit("draw")), F.lit(1 << 20)) < int(share * (1 << 20)))
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(4)).cast("int").alias("part")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(drawn.select("doc_id", "label", part)), "doc_id"
    )
