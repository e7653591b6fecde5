"""Merkle manifest of a dataset: a tree per source over its rows, and a tree over the sources.

Nodes are hashed in runs of 16. Aligned builders take 4,096 consecutive nodes
each and append leaves and inner nodes to a log in the order in which they are
completed (postorder), 32 bytes a node. The roots of the blocks are the leaves
of the next round of builders, until one node is left. Since every subtree has
a known size, the place of any node in its log follows from its level and index
alone (`place`), so siblings are read from the log by address: proofs need no
search and no pointers. The parts above a block are the same for all its rows
and are handed down once per block.

A row's place in its source comes from exact positions over a stored range cut,
so a source of any size spreads over tasks; no group holds more than a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.ordering import cut, positions
from ledgerline.sources.tables import stage

FAN = 16
DEPTH = 3  # levels that a builder closes
BLOCK = FAN**DEPTH

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

STEPS = "array<struct<before: string, after: string>>"
SEGMENT = "tree long, block long, n long, m long, top binary, log binary"
PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def node(*texts: str) -> str:
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def sizes(n: int, depth: int | None = None) -> list[int]:
    """Nodes per level over n leaves: up to `depth` levels above them, or until one node is left."""
    out = [n]
    while out[-1] > 1 if depth is None else len(out) <= depth:
        out.append(-(-out[-1] // FAN))
    return out


def place(level: int, index: int, counts: list[int]) -> int:
    """How many nodes of a postorder log come before a node; `counts` are the nodes per level.

    Below it, all nodes up to the end of its own subtree; beside it, those to
    the left; above it, those whose whole subtree lies to the left.
    """
    below = sum(min((index + 1) * FAN ** (level - k), counts[k]) for k in range(level))
    above = sum(index // FAN ** (k - level) for k in range(level + 1, len(counts)))
    return below + index + above


def completed(leaves: list[bytes], depth: int) -> list[bytes]:
    """All nodes over the leaves in the order of their completion, the top one last."""
    log: list[bytes] = []
    runs: list[list[bytes]] = [[] for _ in range(depth)]

    def append(level: int, digest: bytes) -> None:
        log.append(digest)
        if level < depth:
            runs[level].append(digest)
            if len(runs[level]) == FAN:
                close(level)

    def close(level: int) -> None:
        run, runs[level] = runs[level], []
        append(level + 1, bytes.fromhex(node(*[digest.hex() for digest in run])))

    for digest in leaves:
        append(0, digest)
    for level in range(depth):
        if runs[level]:
            close(level)
    return log


def _depth(n: int) -> int:
    """Levels a builder closes in a tree of n nodes: fewer than `DEPTH` only at the top of a small tree."""
    return len(sizes(n)) - 1 if n <= BLOCK else DEPTH


class Segment:
    """The log of one builder, read by address."""

    def __init__(self, n: int, m: int, log: bytes) -> None:
        self.counts = sizes(m, _depth(n))
        self._log = log

    def digest(self, level: int, index: int) -> str:
        at = 32 * place(level, index, self.counts)
        return self._log[at : at + 32].hex()

    def steps(self, level: int, index: int) -> list[tuple[str, str]]:
        """Siblings before and after the node and each of its ancestors in this segment."""
        out = []
        for k in range(level, len(self.counts) - 1):
            start = index - index % FAN
            run = [self.digest(k, j) for j in range(start, min(start + FAN, self.counts[k]))]
            own = index - start
            out.append(("".join(run[:own]), "".join(run[own + 1 :])))
            index //= FAN
        return out


def _built(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The segment of one block; rows: tree, block, index, n, digest."""
    table = table.sort_by("index")
    n = table.column("n")[0].as_py()
    log = completed(table.column("digest").to_pylist(), _depth(n))
    row = [key[0].as_py(), key[1].as_py(), n, table.num_rows, log[-1], b"".join(log)]
    names = ["tree", "block", "n", "m", "top", "log"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    return pa.table([pa.array([value], kind) for value, kind in zip(row, kinds, strict=True)], names)


def _handed_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each leaf of a segment (a block of the round below) the steps above it."""
    kind = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
    for batch in batches:
        for row in batch.to_pylist():
            segment = Segment(row["n"], row["m"], row["log"])
            above = [(s["before"], s["after"]) for s in row["steps"]]
            paths = [
                [{"before": b, "after": a} for b, a in segment.steps(0, i) + above] for i in range(row["m"])
            ]
            first = row["block"] * BLOCK
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["tree"]] * row["m"], pa.int64()),
                    pa.array(range(first, first + row["m"]), pa.int64()),
                    pa.array(paths, kind),
                    pa.array([row["subroot"]] * row["m"], pa.string()),
                    pa.array([row["root"]] * row["m"], pa.string()),
                ],
                ["tree", "block", "steps", "subroot", "root"],
            )


def _proved(key: tuple[pa.Scalar, ...], rows: pa.Table, segments: pa.Table) -> pa.Table:
    """Proofs of the rows of one block, and the root as folded from each row's leaf."""
    top = segments.to_pylist()[0]
    segment = Segment(top["n"], top["m"], top["log"])
    above = [(s["before"], s["after"]) for s in top["steps"]]
    tail = "".join(before + after for before, after in above)
    shared: dict[int, list[tuple[str, str]]] = {}  # steps above a run, the same for its 16 leaves
    out: dict[str, list] = {name: [] for name in ("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")}
    for index, leaf, changed in zip(*[rows.column(c).to_pylist() for c in ("index", "digest", "changed")], strict=True):
        local = index % BLOCK
        if len(segment.counts) > 1:
            if local // FAN not in shared:
                shared[local // FAN] = segment.steps(1, local // FAN)
            start = local - local % FAN
            run = [segment.digest(0, j) for j in range(start, min(start + FAN, top["m"]))]
            steps = [("".join(run[: local - start]), "".join(run[local - start + 1 :])), *shared[local // FAN]]
        else:
            steps = []
        folded = (changed or leaf).hex()
        for before, after in steps + above:
            folded = node(before, folded, after)
        out["leaf"].append(leaf.hex())
        out["subroot"].append(top["subroot"])
        out["root"].append(top["root"])
        out["proof_sha256"].append(node(*[before + after for before, after in steps], tail))
        out["folded_root"].append(folded)
        out["verified"].append(folded == top["root"])
    kinds = {name: pa.bool_() if name == "verified" else pa.string() for name in out}
    columns = [rows.column("doc_id"), *[pa.array(out[name], kinds[name]) for name in out]]
    return pa.table(columns, ["doc_id", *out])


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """Digest of a row: every field as byte count, colon and value, or `-` if null."""
    return F.sha2(F.concat(*[_field(c) for c in (doc_id, source, lang, n_chars, text)]).cast("binary"), 256)


def tampered(doc_id: Column, text: Column) -> Column:
    """The text in lower case (A-Z only) where 5 divides the crc32 of the id; null elsewhere."""
    hit = F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0
    return F.when(hit, F.translate(text, UPPER, LOWER))


def leaves(docs: DataFrame) -> DataFrame:
    """Staged leaves: tree (rank of the source), index in it, n (leaves of the tree), doc_id, source, digest, changed.

    `changed` is the leaf of the tampered row, null where nothing was tampered.
    """
    fields = ["doc_id", "source", "lang", "n_chars"]
    changed = tampered(F.col("doc_id"), F.col("text"))
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.unhex(leaf_of(*[F.col(c) for c in fields], F.col("text"))).alias("digest"),
        F.when(changed != F.col("text"), F.unhex(leaf_of(*[F.col(c) for c in fields], changed))).alias("changed"),
        F.monotonically_increasing_id().alias("tie"),  # lets the cut fall between equal rows
    )
    order = [F.asc_nulls_first("source"), F.asc_nulls_first("doc_id"), F.asc("digest"), F.asc("tie")]
    stored = cut(slim, order, "merkle-rows")
    counts = stored.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    by_source = [F.asc_nulls_first("source")]
    trees = positions(cut(counts, by_source, "merkle-sources"), by_source, F.col("n"))
    trees = trees.select(F.col("source").alias("_source"), "n", F.col("_row").alias("tree"), F.col("_before").alias("first"))
    rows = positions(stored, order).join(trees, F.col("source").eqNullSafe(F.col("_source")))
    index = (F.col("_row") - F.col("first")).alias("index")
    return stage(rows.select("tree", index, "n", "doc_id", "source", "digest", "changed"), "merkle-leaves")


def _grouped(nodes: DataFrame):
    return nodes.withColumn("block", F.floor(F.col("index") / BLOCK)).groupBy("tree", "block")


def rounds(nodes: DataFrame) -> list[DataFrame]:
    """Staged segments of each round of builders over nodes (tree, index, n, digest); none without nodes."""
    out = []
    while True:
        nodes = nodes.select("tree", "index", "n", "digest")
        segments = stage(_grouped(nodes).applyInArrow(_built, SEGMENT), "merkle-segments")
        largest = segments.agg(F.max("n")).first()[0]
        if largest is None:
            return out
        out.append(segments)
        if largest <= BLOCK:
            return out
        higher = F.ceil(F.col("n") / BLOCK).cast("long").alias("n")
        nodes = segments.filter(F.col("n") > BLOCK).select(
            "tree", F.col("block").alias("index"), higher, F.col("top").alias("digest")
        )


def _whole(segments: DataFrame) -> DataFrame:
    """Segments that close their tree."""
    return segments.filter(F.col("n") <= BLOCK)


def subroots(built: list[DataFrame]) -> DataFrame:
    tops = [_whole(segments).select("tree", F.col("top").alias("digest")) for segments in built]
    out = tops[0]
    for more in tops[1:]:
        out = out.unionByName(more)
    return out


def _with_steps(built: list[DataFrame], above: DataFrame) -> DataFrame:
    """The segments of the lowest round with the steps above them, their subroot and the root.

    `above` has them per tree: tree, steps, subroot, root. Rounds are visited from the top.
    """
    below = None
    for segments in reversed(built):
        rows = _whole(segments).join(above, "tree")
        if below is not None:
            rows = rows.unionByName(segments.filter(F.col("n") > BLOCK).join(below, ["tree", "block"]))
        held = stage(rows, "merkle-steps")
        handed = f"tree long, block long, steps {STEPS}, subroot string, root string"
        below = held.select("tree", "block", "n", "m", "log", "steps", "subroot", "root").mapInArrow(_handed_down, handed)
    return held


def manifest(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Leaves, and the segments over them with all that proofs need (None without rows)."""
    rows = leaves(docs)
    built = rounds(rows)
    if not built:
        return rows, None
    tops = stage(subroots(built), "merkle-subroots")
    n = tops.count()
    over = rounds(tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("index"), F.lit(n).cast("long").alias("n"), "digest"))
    root = F.lower(F.hex("top"))
    last = _whole(over[-1]).select("tree", F.array().cast(STEPS).alias("steps"), root.alias("subroot"), root.alias("root"))
    per_source = _with_steps(over, last).select("tree", "block", "n", "m", "log", "steps", "subroot", "root")
    handed = per_source.mapInArrow(_handed_down, f"tree long, block long, steps {STEPS}, subroot string, root string")
    above = handed.select(F.col("block").alias("tree"), "steps", "root").join(tops, "tree")
    above = stage(above.select("tree", "steps", F.lower(F.hex("digest")).alias("subroot"), "root"), "merkle-above")
    return rows, _with_steps(built, above)


def proofs(docs: DataFrame) -> DataFrame:
    """Leaf, subroot, root, proof digest and the check of the tampered copy of every row.

    Reads doc_id, source, lang, n_chars and text; other columns may have any
    name. Nulls are hashed as `-`; a null source is a source of its own and
    comes first, a null id is the first of its source and is never tampered.
    Repeated rows are leaves of their own; rows of one id are ordered by digest.
    Texts are hashed whole, empty ones as `0:`. An empty table gives an empty
    result.
    """
    rows, segments = manifest(docs)
    if segments is None:
        return docs.sparkSession.createDataFrame([], PROOF)
    own = _grouped(rows.select("tree", "index", "doc_id", "digest", "changed"))
    held = segments.select("tree", "block", "n", "m", "log", "steps", "subroot", "root").groupBy("tree", "block")
    return own.cogroup(held).applyInArrow(_proved, PROOF)


def log(docs: DataFrame) -> DataFrame:
    """The postorder log of every source: source rank (tree), position, level, index and digest of each node."""
    built = rounds(leaves(docs))

    def rows(base: int):
        def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    segment = Segment(row["n"], row["m"], row["log"])
                    whole = sizes(row["leaves"])
                    found = [
                        (base + k, row["block"] * FAN ** (DEPTH - k) + j, segment.digest(k, j))
                        for k in range(1 if base else 0, len(segment.counts))
                        for j in range(segment.counts[k])
                    ]
                    at = [place(level, index, whole) for level, index, _ in found]
                    columns = [[row["tree"]] * len(found), at, *map(list, zip(*found, strict=True))] if found else [[]] * 5
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(values, kind) for values, kind in zip(columns, kinds, strict=True)],
                        ["tree", "position", "level", "index", "digest"],
                    )

        return listed

    schema = "tree long, position long, level int, index long, digest string"
    if not built:
        return docs.sparkSession.createDataFrame([], schema)
    total = built[0].select("tree", F.col("n").alias("leaves")).distinct()
    parts = [
        segments.join(total, "tree").select("tree", "block", "n", "m", "log", "leaves").mapInArrow(rows(DEPTH * i), schema)
        for i, segments in enumerate(built)
    ]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out
