"""Spelling variants: words of a corpus that differ by one code point, and the form each is a variant of.

Near words are found by a dynamic program over sorted lists. Two words that
differ by one edit share the first half of the shorter one or its last half, so
each word is filed under its first half (as it is) and its last half (reversed),
for its own length and for the next shorter one. The words of one such group are
a run of one sorted list. Longest common prefixes of neighbours divide the list
into ranges that share a prefix. A row of an edit matrix (three cells wide, as
one edit allows no more) is computed once for a range and serves all its words;
a range whose shared prefix already exceeds one edit is skipped.

The filed words are cut into parts by range, so a group of any size spreads over
parts. A word visits another part of its group only if the prefix shared by the
words of the group there is still within one edit of it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.sources.tables import stage

RUN = re.compile("[A-Za-zÀ-ÿ]+")
_ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPOILT = 97  # one of so many (document, run) pairs loses a code point
LEAST_LENGTH, LEAST_COUNT = 5, 3
TIMES = 2  # a form is so many times as frequent
HELD = 200_000  # different words a task holds before it hands on their counts
PART_ROWS = 40_000  # filed words of a part, about
QUERIES_AT_ONCE = 8_192  # words whose matrix rows are held at once

FILED = "grp string, word string, n long"
NEAR = "word string, near long, best_n long, best string"


def spoilt(doc_id: int | None, run: str) -> str:
    """A lower-cased run, without one code point if the crc32 of id and run says so."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % SPOILT:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words, summed over the rows of a task as far as memory allows."""
    counts: Counter[str] = Counter()

    def handed_on() -> pa.RecordBatch:
        columns = [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())]
        batch = pa.RecordBatch.from_arrays(columns, ["word", "n"])
        counts.clear()
        return batch

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if not text:
                continue
            for run, n in Counter(RUN.findall(text.translate(_ASCII_LOWER))).items():
                if len(run) >= LEAST_LENGTH:  # a shorter one gives no word, spoilt or not
                    word = spoilt(doc_id, run)
                    if len(word) >= LEAST_LENGTH:
                        counts[word] += n
            if len(counts) > HELD:
                yield handed_on()
    yield handed_on()


def vocabulary(docs: DataFrame) -> DataFrame:
    """Words (word, n) of at least `LEAST_LENGTH` code points and `LEAST_COUNT` occurrences."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = slim.mapInArrow(_counted, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _filings(word: str) -> Iterator[tuple[str, str]]:
    """The groups of a word, and the word as it is sorted there.

    A group is named by side, length of the shorter words and shared half.
    """
    for m in (len(word), len(word) - 1):
        half = m // 2
        yield f"a{m:06}{word[:half]}", word
        turned = word[::-1]
        yield f"b{m:06}{turned[: m - half]}", turned


def _filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            (group, word, n)
            for original, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True)
            for group, word in _filings(original)
        ]
        columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
        arrays = [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, ["grp", "word", "n"])


def shared(one: str, other: str) -> int:
    """Length of the longest common prefix."""
    n = min(len(one), len(other))
    for i in range(n):
        if one[i] != other[i]:
            return i
    return n


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words in one array, each with zeros around it, the place of its first one, and its length."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    text = "".join(f"\0{word}\0\0\0\0" for word in words)
    starts = np.cumsum(lengths + 5) - lengths - 4
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), starts, lengths


def _next_row(band: np.ndarray, letter: np.ndarray, against: np.ndarray) -> np.ndarray:
    """The next row of each edit matrix; three cells around the diagonal, values above one become two.

    `against` holds the code points of the other word at the three columns.
    """
    out = np.empty_like(band)
    differs = (against != letter[:, None]).astype(np.int8)
    out[:, 0] = np.minimum(band[:, 0] + differs[:, 0], band[:, 1] + 1)
    out[:, 1] = np.minimum(np.minimum(band[:, 1] + differs[:, 1], band[:, 2] + 1), out[:, 0] + 1)
    out[:, 2] = np.minimum(band[:, 2] + differs[:, 2], out[:, 1] + 1)
    return np.minimum(out, 2)


_FIRST = np.array([1, 0, 1], dtype=np.int8)
_AROUND = np.array([-1, 0, 1])


class Ranges:
    """The shared prefixes of sorted lists of words, from the longest common prefixes of neighbours.

    A range is the run of words that share a prefix; it knows the last letter of
    it, the ranges one letter longer, and the word that ends there, if any. One
    list per group; the range of a whole group has the length of its shared half.
    """

    def __init__(self, lists: list[tuple[list[str], int]]) -> None:
        letter, ends, parent = [], [], []
        self.roots = []
        place = 0
        for words, depth in lists:
            path = [len(letter)]
            self.roots.append(path[0])
            letter.append(0)
            ends.append(-1)
            parent.append(-1)
            last = words[0] if words else ""
            for word in words:
                common = max(depth, shared(last, word)) if word is not last else depth
                last = word
                del path[common - depth + 1 :]
                for char in word[common:]:
                    parent.append(path[-1])
                    path.append(len(letter))
                    letter.append(ord(char))
                    ends.append(-1)
                ends[path[-1]] = place
                place += 1
        self.letter, self.ends = np.array(letter, dtype=np.uint32), np.array(ends)
        parent = np.array(parent)
        self.longer = np.argsort(parent, kind="stable")
        self.first = np.searchsorted(parent[self.longer], np.arange(len(letter)), "left")
        self.count = np.searchsorted(parent[self.longer], np.arange(len(letter)), "right") - self.first


def scan(lists: list[tuple[list[str], int]], queries: list[str], of_list: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of queries and of the words (counted over all lists) within one edit, a query's own word included.

    A list is a sorted run of distinct words and the length of their shared
    half, which its queries share, too. Each row of an edit matrix is computed
    once per query and range, so it serves all words of the range; a range whose
    row has no cell within one edit is skipped with all its words.
    """
    ranges = Ranges(lists)
    codes, starts, lengths = _codes(queries)
    for first in range(0, len(queries), QUERIES_AT_ONCE):
        query = np.arange(first, min(first + QUERIES_AT_ONCE, len(queries)))
        at = np.array([ranges.roots[of_list[q]] for q in query])
        depth = np.array([lists[of_list[q]][1] for q in query])
        band = np.tile(_FIRST, (len(query), 1))
        while len(query):
            ended = ranges.ends[at]
            cell = lengths[query] - depth + 1
            hit = (ended >= 0) & (cell >= 0) & (cell <= 2)
            hit[hit] = band[hit, cell[hit]] <= 1
            if hit.any():
                yield query[hit], ended[hit]
            more = ranges.count[at]
            query, depth, band = np.repeat(query, more), np.repeat(depth, more), np.repeat(band, more, axis=0)
            begin = np.repeat(ranges.first[at], more)
            at = ranges.longer[begin + np.arange(len(begin)) - np.repeat(np.cumsum(more) - more, more)]
            band = _next_row(band, ranges.letter[at], codes[(starts[query] + depth)[:, None] + _AROUND])
            near = band.min(1) <= 1
            query, depth, band, at = query[near], depth[near] + 1, band[near], at[near]


def _half(group: str) -> tuple[bool, int, str]:
    """Side (reversed or not), length of the shorter words, and shared half of a group."""
    return group[0] == "b", int(group[1:7]), group[7:]


class _Best:
    """Near words of each query: how many, and the most frequent one (ties: the smallest)."""

    def __init__(self) -> None:
        self.found: dict[str, tuple[int, int, str]] = {}

    def add(self, query: str, other: str, n: int) -> None:
        count, best_n, best = self.found.get(query, (0, 0, ""))
        if n > best_n or (n == best_n and other < best):
            best_n, best = n, other
        self.found[query] = (count + 1, best_n, best)


def _as_table(best: _Best) -> pa.Table:
    rows = [(word, *found) for word, found in best.found.items()]
    columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["word", "near", "best_n", "best"])


def _within(key: tuple[pa.Scalar, ...], stored: pa.Table, visits: pa.Table) -> pa.Table:
    """Near words in one part: among its own groups, and for the words that visit from other parts."""
    best = _Best()
    own: dict[str, list[tuple[str, int]]] = {}
    for group, word, n in zip(*[stored.column(name).to_pylist() for name in ("grp", "word", "n")], strict=True):
        own.setdefault(group, []).append((word, n))
    guests: dict[str, list[str]] = {}
    for group, word in zip(visits.column("grp").to_pylist(), visits.column("word").to_pylist(), strict=True):
        guests.setdefault(group, []).append(word)
    lists, groups, words, counts, queries, of_list = [], [], [], [], [], []
    for group, members in own.items():
        if len(members) == 1 and group not in guests:
            continue
        members.sort()
        listed = [word for word, _ in members]
        asking = listed + guests.get(group, [])
        queries += asking
        of_list += [len(lists)] * len(asking)
        words += listed
        counts += [n for _, n in members]
        groups.append(_half(group))
        lists.append((listed, len(groups[-1][2])))
    for hits, places in scan(lists, queries, of_list):
        for hit, place in zip(hits.tolist(), places.tolist(), strict=True):
            query, word = queries[hit], words[place]
            turned, m, _ = groups[of_list[hit]]
            # A pair belongs to the groups of its shorter length, and to the reversed ones
            # only if it does not share the first half, so that it counts once.
            if query == word or min(len(word), len(query)) != m:
                continue
            if not turned:
                best.add(query, word, counts[place])
            elif (one := query[::-1])[: m // 2] != (other := word[::-1])[: m // 2]:
                best.add(one, other, counts[place])
    return _as_table(best)


def _reachable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The visits of words to other parts of their group that may hold near words."""
    for batch in batches:
        out: list[tuple[int, str, str]] = []
        for row in batch.to_pylist():
            word, depth = row["word"], len(_half(row["grp"])[2])
            for segment in row["segments"]:
                if segment["part"] == row["part"]:
                    continue
                prefix = segment["low"][: shared(segment["low"], segment["high"])]
                if within_one_edit_of_prefix(prefix, word, depth):
                    out.append((segment["part"], row["grp"], word))
        columns = list(zip(*out, strict=True)) if out else [[], [], []]
        arrays = [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, ["part", "grp", "word"])


def within_one_edit_of_prefix(prefix: str, word: str, depth: int = 0) -> bool:
    """Whether some word that starts with `prefix` may be within one edit of `word`; `depth` letters are the same."""
    codes, starts, _ = _codes([word])
    band = _FIRST[None]
    for at in range(depth, len(prefix)):
        if at > len(word) + 1:
            return False
        band = _next_row(band, np.array([ord(prefix[at])], dtype=np.uint32), codes[starts + at + _AROUND][None])
        if band.min() > 1:
            return False
    return True


def near_words(words: DataFrame) -> DataFrame:
    """For each word that has any: its number of near words, and the largest count among them with its word.

    `words` (word, n) are distinct and staged.
    """
    filed = words.select("word", "n").mapInArrow(_filed, FILED)
    parts = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-4 * words.count() // PART_ROWS))
    ranged = filed.repartitionByRange(parts, "grp", "word").withColumn("part", F.spark_partition_id())
    stored = stage(ranged, "spelling-filed")

    # Only the first and the last group of a part can go on in another one: at most two rows a part.
    ends = stored.groupBy("part").agg(F.min("grp").alias("low"), F.max("grp").alias("high"))
    ends = ends.select(F.explode(F.array_distinct(F.array("low", "high"))).alias("grp"))
    split = stage(ends.groupBy("grp").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("grp"), "spelling-split")
    here = stored.join(F.broadcast(split), "grp")
    segments = here.groupBy("grp", "part").agg(F.min("word").alias("low"), F.max("word").alias("high"))
    segments = segments.groupBy("grp").agg(F.collect_list(F.struct("part", "low", "high")).alias("segments"))
    visits = here.join(F.broadcast(segments), "grp").select("grp", "word", "part", "segments")
    visits = visits.mapInArrow(_reachable, "part int, grp string, word string")

    found = stored.groupBy("part").cogroup(visits.groupBy("part")).applyInArrow(_within, NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    found = found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b"))
    return found.select("word", "n_near", F.col("b.word").alias("best"), (-F.col("b.n")).alias("best_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """word and root: forms (word, form) followed to the last one, by jumps that double in length.

    A form is at least twice as frequent as its word, so there are no cycles,
    and a path has at most 63 steps.
    """
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("far"))
        moved = now.join(further, "root", "left")
        now = stage(moved.select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("went")), "spelling-roots")
        if now.filter("went").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the vocabulary.

    Reads doc_id and text; other columns may have any name. Missing and empty
    texts have no words. A row without an id is spoilt as if its id were the
    empty text. Repeated rows count each time. Of near words of equal count the
    smallest in code-point order is the form. Texts are read whole. An empty
    table gives an empty result.
    """
    words = stage(vocabulary(docs), "spelling-words")
    near = stage(near_words(words), "spelling-near")
    formed = words.join(near, "word", "left")
    is_form = F.col("best_n") >= TIMES * F.col("n")
    formed = stage(
        formed.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best")).alias("form"),
            F.when(is_form, F.col("best_n")).alias("form_n"),
        ),
        "spelling-formed",
    )
    roots = _roots(formed.filter("form is not null"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
