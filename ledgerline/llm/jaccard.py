"""N-gram Jaccard join on count vectors.

The shingles of a text are hashed into groups; the counts per group are a point.
For any grouping, the overlap of two sets is at most the sum of the coordinate
minima of their points. With |A & B| >= 4/9 (|A| + |B|), which a similarity of
0.8 means, two points differ by at most (|A| + |B|) / 9 in all coordinates
together, and so in at most that many coordinates.

1. Texts with equal shingle sets form a class.
2. The space of the finest grouping is cut into blocks of coordinates. By the
   bound, two similar classes agree on a whole block; a class is filed under so
   many of its blocks (the first in one order for all) that similar classes
   share one. Each block value is a leaf page of the index.
3. The members of a page are first compared with one of them only: each class
   with the two such centres it shares most pages with, then with two more that
   it is still apart from. That joins the bulk of any large group of near copies
   in linear work.
4. Where a page still holds several components, its points are packed into an
   R-tree by size; node and point pairs are kept by summed minima of box tops
   and points, and only between different components. Most pages are no larger
   than a leaf; their pairs are bounded many pages at once. Of the pairs that the
   bound leaves in a page, a round takes only as many as join its components
   (a spanning forest), so its pairs grow with the rows and not their square.
5. The pairs of a round are verified on the shingle sets of the whole texts.
   Similar ones join components, the others are told to the next round, which
   takes more forests. The rounds end when the bound leaves no pair between
   different components, so no link between components is missed.

Shingles and classes are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import mix
from ledgerline.llm.graph import components
from ledgerline.llm.shingles import shingle_sets
from ledgerline.sources.tables import stage

PERCENT = 80  # the bounds below are written for this similarity
SINGLE = 64  # classes below this size are filed by single coordinates
FILL = 0.375  # blocks per shingle of the largest class of a size band
LEAF = 32  # points of an R-tree leaf
STEP = 1 << 20  # counts of the points that are unpacked or compared in one step, about
FIRST = 2  # centres that each class is compared with first
FILTER_BITS = 24  # of the table that tells which texts may be wanted: 2 MB
PAGE = 2_048  # points of a page that meet in one task, at most
PAGE_BYTES = 1 << 20  # and their bytes
MOST_FORESTS = 512  # of a round; the first takes two, each later one four times as many
ALONE = 2  # rounds in which the slices of a large page are taken each by itself


def class_of(shingles: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(shingles.tobytes()) - (1 << 63)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def pages(shingles: np.ndarray) -> np.ndarray:
    """The page keys a class is filed under.

    Sizes fall into bands by powers of two. A class is filed in its own band, and
    in the next one if a similar class can be that large. In a band, similar
    classes of sizes a and b differ in d <= (a + b) / 9 shingles, hence in at most
    d blocks; of their sorted block keys, the first d + 1 of each share one.
    """
    n = len(shingles)
    if n < 4:  # no different set is similar to one this small
        return np.empty(0, dtype=np.uint64)
    band = n.bit_length() - 1
    out = []
    for b in (band, band + 1):
        if b > band and 5 * n < 4 << b:
            continue
        largest = (2 << b) - 1
        spare = (n + min(largest, 5 * n // 4)) // 9
        if largest < SINGLE:
            keys = mix(shingles ^ np.uint64(0xA5A5 + b))
        else:
            blocks = np.uint64(int(FILL * largest) + 1)
            block = ((shingles >> np.uint64(32)) * blocks) >> np.uint64(32)
            starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
            content = np.add.reduceat(mix(shingles), starts)
            keys = mix(content ^ mix(block[starts] + np.uint64(b << 40)))
        if len(keys) > spare + 1:
            keys = np.partition(keys, spare)[: spare + 1]
        out.append(keys)
    return np.concatenate(out)


def group_bits(n: int) -> int:
    """Groups of a class's point, as a power of two: about 2 to 4 shingles each, 256 at least."""
    return max(8, n.bit_length() - 2)


def point(shingles: np.ndarray) -> np.ndarray:
    bits = group_bits(len(shingles))
    return np.bincount((shingles >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits).astype(np.int32)


def packed(counts: np.ndarray) -> bytes:
    """A point in as few bytes as its counts need; the first byte tells the bits of a count."""
    top = counts.max(initial=0)
    if top < 16:
        return b"\x04" + (counts[::2] | counts[1::2] << 4).astype(np.uint8).tobytes()
    kind = np.uint8 if top < 256 else np.int32
    return bytes([8 * np.dtype(kind).itemsize]) + counts.astype(kind).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    if data[0] == 4:
        pairs = np.frombuffer(data, dtype=np.uint8, offset=1)
        counts = np.empty(2 * len(pairs), dtype=np.int32)
        counts[::2], counts[1::2] = pairs & 15, pairs >> 4
        return counts
    return np.frombuffer(data, dtype=np.uint8 if data[0] == 8 else np.int32, offset=1).astype(np.int32)


def fold(counts: np.ndarray, bits: int) -> np.ndarray:
    """A point over fewer groups: neighbours added up."""
    return counts if len(counts) == 1 << bits else counts.reshape(1 << bits, -1).sum(1)


def linking_pairs(
    points: np.ndarray,
    sizes: np.ndarray,
    roots: np.ndarray,
    side: np.ndarray,
    refused: dict[int, list[int]] | None = None,
    forests: int = 1,
) -> tuple[list[tuple[int, int]], bool]:
    """Pairs of rows of different roots (and sides, if there are two) that the bound leaves and that join roots.

    Each of the `forests` joins, as far as the pairs allow, all roots that can be
    joined, and holds fewer pairs than there are rows; no pair is in two of them.
    Pairs that are `refused` (both ways) are left out. Also tells whether the
    bound may leave pairs that no forest took.

    An R-tree of one level, packed by size: boxes hold the highest count of each
    group and the smallest size of a leaf. The minima of two points sum up to the
    number of (group, k) for which both have k or more: a product of 0/1 rows.
    """
    order = np.argsort(sizes, kind="stable")
    points, sizes, roots, side = points[order], sizes[order], roots[order], side[order]
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    refused = refused or {}
    starts = np.arange(0, len(order), LEAF)
    tops = np.maximum.reduceat(points, starts, axis=0)
    lows, highs = sizes[starts], np.maximum.reduceat(sizes, starts)
    reached = []
    for k in range(1, int(points.max(initial=0)) + 1):
        has = points >= k
        reached.append(has[:, has.sum(0) > 1].astype(np.float32))
    reached = np.hstack(reached) if reached else np.zeros((len(order), 1), dtype=np.float32)
    two = side.min() != side.max()
    named = np.tile(np.unique(roots, return_inverse=True)[1], (forests, 1))
    out, left = [], False
    for i, start in enumerate(starts):
        others = np.arange(i, len(starts))
        others = others[100 * highs[i] >= PERCENT * lows[others]]
        bound = np.minimum(tops[i], tops[others]).sum(1)
        others = others[9 * bound >= 4 * (lows[i] + lows[others])]
        if not len(others):
            continue
        inside = (others[:, None] * LEAF + np.arange(LEAF)).ravel()
        inside = inside[inside < len(order)]
        rows = np.arange(start, min(start + LEAF, len(order)))
        both = np.rint(reached[rows] @ reached[inside].T).astype(np.int64)
        near = 9 * both >= 4 * (sizes[rows, None] + sizes[inside])
        near &= (inside > rows[:, None]) & (roots[inside] != roots[rows, None])
        near &= 100 * sizes[rows, None] >= PERCENT * sizes[inside]
        if two:
            near &= side[inside] != side[rows, None]
        for x in rows[near.any(1)]:
            y, overlap = inside[near[x - start]], both[x - start, near[x - start]]
            if int(order[x]) in refused:
                new = ~np.isin(y, place[refused[int(order[x])]])
                y, overlap = y[new], overlap[new]
            y = y[np.argsort(-overlap / (sizes[x] + sizes[y]), kind="stable")]  # the likeliest first
            for name in named:
                if not len(y):
                    break
                _, first = np.unique(name[y], return_index=True)
                taken = first[name[y[first]] != name[x]]
                if len(taken):
                    out += [(int(order[x]), int(order[z])) for z in y[taken]]
                    name[np.isin(name, name[y[taken]])] = name[x]
                    y = np.delete(y, taken)
            left |= len(y) > 0
    return out, left


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The size of each text's shingle set, its class and its point."""
    for batch in batches:
        sizes, classes, points = [], [], []
        for shingles in shingle_sets(batch.column("text")):
            sizes.append(len(shingles))
            classes.append(class_of(shingles) if len(shingles) else None)
            points.append(packed(point(shingles)) if len(shingles) else None)
        columns = [batch.column(name) for name in ("doc_id", "h1", "h2")]
        columns += [pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()), pa.array(points, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "h1", "h2", "n", "cls", "point"])


def _filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pages of each class, once for each class that a task meets."""
    seen = set()
    for batch in batches:
        classes, keys = [], []
        for shingles in shingle_sets(batch.column("text")):
            if len(shingles) >= 4 and (name := class_of(shingles)) not in seen:
                seen.add(name)
                classes.append(name)
                keys.append(pages(shingles).view(np.int64))
        sizes = np.cumsum([0] + [len(k) for k in keys])
        values = np.concatenate(keys) if keys else np.empty(0, dtype=np.int64)
        lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(values, pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(classes, pa.int64()), lists], ["cls", "pages"])


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("h1"),
        F.xxhash64(F.lit(1), F.col("text")).alias("h2"),
        "text",
    )


def _maybe(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """`rows` with `maybe`, false where (`h1`, `h2`) is surely not in `wanted`.

    A table of 2 ** `FILTER_BITS` bits, broadcast in pieces of 4 KB, tells. It
    only saves moving texts; a join decides about the others.
    """
    slot = F.pmod("h1", F.lit(1 << FILTER_BITS))
    bits = wanted.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("piece"))
    bits = F.broadcast(bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")))
    byte = "conv(hex(substring(bits, cast(place div 8 as int) + 1, 1)), 16, 10)"
    bit = F.expr(f"shiftright(cast({byte} as int), cast(place % 8 as int)) % 2 = 1")
    return (
        rows.withColumn("piece", F.bitmap_bucket_number(slot))
        .withColumn("place", F.bitmap_bit_position(slot))
        .join(bits, "piece", "left")
        .withColumn("maybe", F.coalesce(bit, F.lit(False)))
        .drop("piece", "place", "bits")
    )


def _some(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of `texts` whose (`h1`, `h2`) is in `wanted`, one for each."""
    near = _maybe(texts, wanted).filter("maybe").drop("maybe")
    return near.join(wanted, ["h1", "h2"]).dropDuplicates(["h1", "h2"])


def _bound(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """Pairs (`a`, `b`) whose summed coordinate minima leave the similarity possible."""

    def left(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = []
            for one, other, m, n in zip(batch["pa"], batch["pb"], batch["na"], batch["nb"], strict=True):
                one, other = unpacked(one), unpacked(other)
                bits = min(len(one), len(other)).bit_length() - 1
                good.append(9 * int(np.minimum(fold(one, bits), fold(other, bits)).sum()) >= 4 * (m + n))
            yield batch.loc[good, ["a", "b"]]

    one = points.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("point").alias("pa"))
    other = points.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("point").alias("pb"))
    near = (100 * F.least("na", "nb")) >= PERCENT * F.greatest("na", "nb")
    return pairs.select("a", "b").join(one, "a").join(other, "b").filter(near).mapInPandas(left, "a long, b long")


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (`a`, `b`; a staged frame) of classes whose shingle sets are similar.

    Only the texts of classes in the pairs are moved.
    """
    named = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
    wanted = stage(named.join(classes, "cls").select("cls", "h.h1", "h.h2"), "jaccard-wanted")
    texts = stage(_some(_hashed(docs).drop("doc_id"), wanted).select("cls", "text"), "jaccard-texts")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = zip(shingle_sets(batch.column("text_a")), shingle_sets(batch.column("text_b")), strict=True)
            good = pa.array([similar(one, other) for one, other in sets], pa.bool_())
            yield batch.select(["a", "b"]).filter(good)

    one = texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a"))
    other = texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b"))
    return pairs.select("a", "b").join(one, "a").join(other, "b").mapInArrow(verify, "a long, b long")


def _page_pairs(rows: DataFrame, turn: int) -> DataFrame:
    """The pairs (`a`, `b`) that a round takes, and the pages (`page`) it has not done with; rows: page, cls, n, root, point, refused, main, units, others.

    `units` and `others` tell for how many tasks the page's main root and all its
    other roots have rows. A page for more than one task is dealt into slices; of
    the main root, only pairs with slices of the others meet. In the first rounds
    each slice is taken by itself, which joins most of a large group cheaply.
    """
    draw = F.xxhash64("cls", F.lit(turn))
    small = F.col("units") + F.col("others") <= 1
    main = F.col("root") == F.col("main")
    mains, rest = F.greatest(F.lit(1), F.ceil("units")).cast("int"), F.greatest(F.lit(1), F.ceil("others")).cast("int")
    every = F.ceil(F.col("units") + F.col("others")).cast("int")
    if turn < ALONE:
        slice_ = F.when(small, 0).otherwise(F.pmod(draw, every)).cast("int")
        other = F.array("slice")
    else:
        slice_ = F.when(small, 0).when(main, F.pmod(draw, mains)).otherwise(mains + F.pmod(draw, rest)).cast("int")
        other = F.when(small, F.array(F.lit(0))).otherwise(
            F.sequence(F.when(main, mains).otherwise(0), mains + rest - 1)
        )
    dealt = rows.withColumn("slice", slice_).withColumn("other", F.explode(other))
    dealt = dealt.withColumn("one", F.least("slice", "other")).withColumn("two", F.greatest("slice", "other"))

    columns = ["page", "one", "two", "slice", "cls", "n", "root", "point", "refused"]
    group = ["page", "one", "two"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    together = dealt.select(*columns).repartition(parts, *group).sortWithinPartitions(*group, "cls")
    forests = min(2 << 2 * turn, MOST_FORESTS)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _kept_pairs(batches, forests)

    return together.mapInArrow(kept, "a long, b long, page long").distinct()


def _kept_pairs(batches: Iterator[pa.RecordBatch], forests: int) -> Iterator[pa.RecordBatch]:
    """The pairs taken in each run of rows of one group; rows come sorted by group."""
    held = None
    for batch in batches:
        rows = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in batch.schema.names}
        if held is not None:
            rows = {name: np.concatenate([held[name], values]) for name, values in rows.items()}
        if not len(rows["page"]):
            continue
        new = np.zeros(len(rows["page"]), dtype=bool)
        for name in ("page", "one", "two"):
            new[1:] |= rows[name][1:] != rows[name][:-1]
        borders = np.concatenate([[0], np.flatnonzero(new)])
        yield from _groups_pairs(rows, borders, forests)
        held = {name: values[borders[-1] :] for name, values in rows.items()}  # its group may go on
    if held is not None:
        yield from _groups_pairs(held, np.array([0, len(held["page"])]), forests)


def _groups_pairs(rows: dict[str, np.ndarray], borders: np.ndarray, forests: int) -> Iterator[pa.RecordBatch]:
    """The pairs of the groups between the borders. Groups of a leaf or less, most of them, are taken many at once."""
    rows = rows | {"bits": np.array([_width_bits(data) for data in rows["point"]], dtype=np.int64)}
    starts, lengths = borders[:-1], np.diff(borders)
    for start, length in zip(starts[lengths > LEAF], lengths[lengths > LEAF], strict=True):
        yield from _pairs_of({name: values[start : start + length] for name, values in rows.items()}, forests)
    starts, lengths = starts[lengths <= LEAF], lengths[lengths <= LEAF]
    step = np.cumsum(np.append(0, 1 << rows["bits"]))[starts] // STEP
    for part in np.unique(step):
        yield from _small_pairs(rows, starts[step == part], lengths[step == part], forests)


def _small_pairs(
    rows: dict[str, np.ndarray], starts: np.ndarray, lengths: np.ndarray, forests: int
) -> Iterator[pa.RecordBatch]:
    """What `_pairs_of` yields for groups of a few rows, for many of them: all pairs of a group meet the bound."""
    root, n, cls, side = rows["root"], rows["n"], rows["cls"], rows["slice"]
    one, other, group = [], [], []
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        i, j = np.triu_indices(length, 1)
        one.append((starts[at, None] + i).ravel())
        other.append((starts[at, None] + j).ravel())
        group.append(np.repeat(at, len(i)))
    if not one:
        return
    one, other, group = np.concatenate(one), np.concatenate(other), np.concatenate(group)
    open_ = (root[one] != root[other]) & (100 * np.minimum(n[one], n[other]) >= PERCENT * np.maximum(n[one], n[other]))
    open_ &= (rows["one"][one] == rows["two"][one]) | (side[one] != side[other])
    one, other, group = one[open_], other[open_], group[open_]
    both = overlaps(rows["point"], rows["bits"], one, other)
    near = 9 * both >= 4 * (n[one] + n[other])
    one, other, group, both = one[near], other[near], group[near], both[near]
    known = {int(x): rows["refused"][x] for x in np.unique([one, other]) if rows["refused"][x] is not None}
    if known:
        known = {x: set(names.tolist()) for x, names in known.items()}
        new = [
            cls[y] not in known.get(x, ()) and cls[x] not in known.get(y, ())
            for x, y in zip(one.tolist(), other.tolist(), strict=True)
        ]
        one, other, group, both = one[new], other[new], group[new], both[new]
    if not len(one):
        return
    order = np.lexsort((-both / (n[one] + n[other]), group))  # the likeliest of a group first
    one, other, group = one[order], other[order], group[order]
    ends = np.flatnonzero(np.append(group[1:] != group[:-1], True)) + 1
    taken, left = np.ones(len(one), dtype=bool), []
    for start, end in zip(np.append(0, ends[:-1]), ends, strict=True):
        if end - start > 1:
            taken[start:end] = in_forests(root[one[start:end]].tolist(), root[other[start:end]].tolist(), forests)
            if not taken[start:end].all():
                left.append(rows["page"][one[start]])
    yield _taken(np.stack([cls[one[taken]], cls[other[taken]]], 1), left)


def overlaps(points: np.ndarray, bits_of: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The summed minima of the (packed) points of each pair of places, over as many groups as both have."""
    fewer = np.minimum(bits_of[one], bits_of[other])
    out = np.empty(len(one), dtype=np.int64)
    for bits in np.unique(fewer):
        pairs = np.flatnonzero(fewer == bits)
        used, place = np.unique([one[pairs], other[pairs]], return_inverse=True)
        counts = _folded(points[used], int(bits))
        first, second = place.reshape(2, -1)
        step = max(1, STEP >> bits)
        for i in range(0, len(pairs), step):
            least = np.minimum(counts[first[i : i + step]], counts[second[i : i + step]])
            out[pairs[i : i + step]] = least.sum(1, dtype=np.int64)
    return out


def _folded(points: np.ndarray, bits: int) -> np.ndarray:
    """The packed points as rows over 1 << `bits` groups."""
    rows = np.empty((len(points), 1 << bits), dtype=np.int32)
    forms = np.array([data[0] << 32 | len(data) for data in points], dtype=np.int64)
    for form in np.unique(forms):
        same = np.flatnonzero(forms == form)
        data = np.frombuffer(b"".join(points[same]), dtype=np.uint8).reshape(len(same), -1)[:, 1:]
        if form >> 32 == 4:
            data = np.stack([data & 15, data >> 4], 2)
        elif form >> 32 == 32:
            data = np.ascontiguousarray(data).view(np.int32)
        rows[same] = data.reshape(len(same), 1 << bits, -1).sum(2, dtype=np.int32)
    return rows.astype(np.uint8) if rows.max(initial=0) < 256 else rows


def in_forests(one: list[int], other: list[int], forests: int) -> list[bool]:
    """Which of the pairs of roots the forests take: each pair goes to the first in which it joins two trees."""
    trees: list[dict[int, int]] = []
    taken = []
    for x, y in zip(one, other, strict=True):
        for k in range(forests):
            if k == len(trees):
                trees.append({root: root for root in {*one, *other}})
            names = trees[k]
            if (mine := names[x]) != (theirs := names[y]):
                names.update({root: mine for root, name in names.items() if name == theirs})
                break
        else:
            taken.append(False)
            continue
        taken.append(True)
    return taken


def _pairs_of(rows: dict[str, np.ndarray], forests: int) -> Iterator[pa.RecordBatch]:
    root, n, cls = rows["root"], rows["n"], rows["cls"]
    if (root == root[0]).all():
        return
    bits = int(rows["bits"].min())
    counts = [fold(unpacked(data), bits) for data in rows["point"]]
    place = {int(name): i for i, name in enumerate(cls)}
    refused: dict[int, list[int]] = {}
    for i, names in enumerate(rows["refused"]):
        for name in names if names is not None else ():
            if (j := place.get(int(name))) is not None:
                refused.setdefault(i, []).append(j)
                refused.setdefault(j, []).append(i)
    points = np.empty((len(counts), 1 << bits), dtype=np.uint8 if max(int(c.max()) for c in counts) < 256 else np.int32)
    for i, c in enumerate(counts):
        points[i] = c
    pairs, left = linking_pairs(points, n, root, rows["slice"], refused, forests)
    if pairs or left:
        yield _taken(cls[np.array(pairs, dtype=np.int64).reshape(-1, 2)], [rows["page"][0]] * left)


def _taken(pairs: np.ndarray, left: list[int]) -> pa.RecordBatch:
    """Pairs of classes, and the pages that are not done with."""
    high = pa.array([*pairs.max(1).tolist(), *[None] * len(left)], pa.int64())
    low = pa.array([*pairs.min(1).tolist(), *[None] * len(left)], pa.int64())
    page = pa.array([None] * len(pairs) + [int(name) for name in left], pa.int64())
    return pa.RecordBatch.from_arrays([high, low, page], ["a", "b", "page"])


def _width_bits(data: bytes) -> int:
    """Groups of a packed point, as a power of two."""
    groups = 2 * (len(data) - 1) if data[0] == 4 else (len(data) - 1) // (data[0] // 8)
    return groups.bit_length() - 1


def _open_rows(members: DataFrame, groups: DataFrame, sizes: DataFrame) -> DataFrame:
    """Members (page, cls) of pages that hold several components, with what `_page_pairs` needs but the points."""
    rooted = members.join(groups.select(F.col("node").alias("cls"), "root"), "cls", "left").join(sizes, "cls")
    rooted = rooted.withColumn("root", F.coalesce("root", "cls"))
    per_root = rooted.groupBy("page", "root").agg(F.sum("unit").alias("units"))
    most = F.max(F.struct("units", "root"))
    pages_ = per_root.groupBy("page").agg(F.sum("units").alias("all"), most.alias("most"), F.count(F.lit(1)).alias("roots"))
    pages_ = pages_.filter("roots > 1").select(
        "page", F.col("most.root").alias("main"), F.col("most.units").alias("units"), (F.col("all") - F.col("most.units")).alias("others")
    )
    return rooted.select("page", "cls", "n", "root").join(pages_, "page")


def _joined_pages(
    shared: DataFrame, groups: DataFrame, refused: DataFrame, classes: DataFrame, docs: DataFrame
) -> DataFrame:
    """Components after all pairs that the bound leaves in the pages have been verified or made needless."""
    width = F.greatest(F.lit(256.0), F.pow(F.lit(2.0), F.floor(F.log2("n")) - 1))
    unit = F.greatest(F.lit(1.0 / PAGE), width / PAGE_BYTES).alias("unit")
    sizes = classes.select("cls", "n", unit)
    members, turn = shared.select("page", "cls"), 0
    while True:
        rows = stage(_open_rows(members, groups, sizes), "jaccard-open")
        known = refused.groupBy(F.col("a").alias("cls")).agg(F.collect_list("b").alias("refused"))
        full = rows.join(classes.select("cls", "point"), "cls").join(known, "cls", "left")
        found = stage(_page_pairs(full, turn), "jaccard-pairs")
        pairs = found.filter("page is null").select("a", "b")
        good = stage(_verified(pairs, classes, docs), "jaccard-good")
        refused = stage(refused.unionByName(pairs.join(good, ["a", "b"], "left_anti")), "jaccard-refused")
        groups = stage(components(good.unionByName(_as_links(groups))), "jaccard-groups")
        undone = found.filter("page is not null").select("page")
        if turn < ALONE:  # pairs of slices have not met
            undone = undone.unionByName(rows.filter(F.col("units") + F.col("others") > 1).select("page")).distinct()
        members, turn = rows.select("page", "cls").join(undone, "page", "left_semi"), turn + 1
        if undone.isEmpty():
            return groups


def _as_links(groups: DataFrame) -> DataFrame:
    """Components found so far as links to their roots."""
    return groups.select(F.col("node").alias("a"), F.col("root").alias("b"))


def linked(docs: DataFrame) -> DataFrame:
    """Components of documents under links between similar shingle sets.

    Reads `doc_id` and `text`; other columns may have any name. Returns one row
    per row: doc_id, h1, h2 (hashes of the text), n (set size), root (a name of
    the component) and component_id, the smallest doc_id in it. Texts without
    words, or missing, have n 0, no root, and their own id as component_id. Rows
    without an id take part; they count for a component's id only if no row of
    it has one (then it is null). Repeated rows are one class. An empty table
    gives an empty result.
    """
    slim = _hashed(docs).mapInArrow(_sets, "doc_id long, h1 long, h2 long, n long, cls long, point binary")
    slim = stage(slim, "jaccard-slim")
    filed = docs.select("text").mapInArrow(_filed, "cls long, pages array<long>")
    page = Window.partitionBy("page")
    shared = (
        filed.select("cls", F.explode("pages").alias("page"))
        .withColumn("low", F.min("cls").over(page))
        .withColumn("high", F.max("cls").over(page))
        .filter("low != high")
        .select("page", "cls", "low")
        .distinct()
    )
    shared = stage(shared, "jaccard-pages")
    classes = stage(
        slim.filter("cls is not null")
        .groupBy("cls")
        .agg(F.min("doc_id").alias("least"), F.min(F.struct("h1", "h2", "point")).alias("h"), F.max("n").alias("n"))
        .withColumn("point", F.col("h.point")),
        "jaccard-classes",
    )
    points = classes.select("cls", "n", "point")

    best = Window.partitionBy("a").orderBy(F.desc("shared"), "b")
    stars = shared.filter("cls != low").groupBy(F.col("cls").alias("a"), F.col("low").alias("b"))
    stars = stage(
        stars.agg(F.count(F.lit(1)).alias("shared")).withColumn("rank", F.row_number().over(best)), "jaccard-stars"
    )
    near = stage(_bound(stars.filter(F.col("rank") <= FIRST), points), "jaccard-near")
    good = stage(_verified(near, classes, docs), "jaccard-good")
    groups = stage(components(good), "jaccard-groups")

    def apart(pairs: DataFrame) -> DataFrame:
        one = groups.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        other = groups.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        rooted = pairs.join(one, "a", "left").join(other, "b", "left")
        return rooted.filter(F.coalesce("ra", "a") != F.coalesce("rb", "b"))

    others = apart(stars.filter(F.col("rank") > FIRST)).withColumn("rank", F.row_number().over(best))
    rest = stage(_bound(others.filter(F.col("rank") <= FIRST).select("a", "b"), points), "jaccard-rest")
    more = stage(_verified(rest, classes, docs), "jaccard-good")
    groups = stage(components(more.unionByName(_as_links(groups))), "jaccard-groups")

    tested = near.join(good, ["a", "b"], "left_anti").unionByName(rest.join(more, ["a", "b"], "left_anti"))
    groups = _joined_pages(shared, groups, stage(tested, "jaccard-refused"), classes, docs)

    named = classes.select("cls", "least").join(groups.select(F.col("node").alias("cls"), "root"), "cls", "left")
    named = named.withColumn("root", F.coalesce("root", "cls"))
    ids = named.groupBy("root").agg(F.min("least").alias("component"))
    named = stage(named.select("cls", "root").join(ids, "root"), "jaccard-named")
    return slim.join(named, "cls", "left").select(
        "doc_id",
        "h1",
        "h2",
        "n",
        "root",
        F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """`docs` with one row of each component: that of the smallest id (a missing one last), ties to the
    smaller text hash.

    Rows without words stay as they are. All columns are kept.
    """
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h1", "h2")
    found = stage(linked(docs).filter("n > 0").select("doc_id", "h1", "h2", "root"), "jaccard-found")
    crowds = found.groupBy("root").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    chosen = (F.col("h1") == F.col("first.h1")) & (F.col("h2") == F.col("first.h2"))
    crowd = found.join(crowds, "root").select("h1", "h2", chosen.alias("chosen"), _who(F.col("first.doc_id")).alias("who"))
    crowd = stage(crowd.distinct(), "jaccard-crowd")

    text = F.col("_row.text")
    rows = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_row"))
    rows = rows.withColumns({"h1": F.xxhash64(text), "h2": F.xxhash64(F.lit(1), text)})
    marked = _maybe(rows.withColumn("who", _who(F.col("_row.doc_id"))), crowd)
    near = marked.filter("maybe")
    first = near.join(crowd.filter("chosen"), ["h1", "h2", "who"]).dropDuplicates(["h1", "h2", "who"])
    alone = marked.filter("not maybe").select("_row").unionByName(
        near.join(crowd.select("h1", "h2"), ["h1", "h2"], "left_anti").select("_row")
    )
    return alone.unionByName(first.select("_row")).select("_row.*")


def _who(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long").cast("string"), F.lit("none"))
