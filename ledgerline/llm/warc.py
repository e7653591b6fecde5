"""WARC archives: a deterministic sharded writer, and a reader.

Records are put in the order (page id, payload digest); the exact running total
of their bytes cuts the order into shards, so the same records give the same
files on every run, whatever the partitions. A shard's task streams its rows,
writes one gzip member per record and starts a new file once the compressed
size reaches a limit. Files are written under temporary names; the manifest that
Spark commits names the files of exactly one attempt of each task, and a second
job renames those.

Executors reach the archive folder through Arrow's file systems (local or
mounted folders, hdfs, s3, gs).
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.ordering import cut, positions
from ledgerline.sources.tables import stage

LEAST_REVISIT = 100  # bytes of a payload from which equal ones become revisits
SHARD_BYTES = 64 << 20  # payload and header bytes of a shard, at least
MAX_SHARDS = 10_000  # beyond it shards grow instead; their borders are what tasks are told
ROLL_BYTES = 16 << 20  # compressed bytes at which a shard starts its next file
HEADER_BYTES = 700  # taken as the size of a record besides its payload
LEVEL = 4
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:page-archive")

MANIFEST = "shard int, seq int, name string, temporary string, records long, bytes long, sha256 string"
RECORD = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "payload binary"
)


def classified(pages: DataFrame) -> DataFrame:
    """One row per page without its payload: size, digest, record type and what a revisit refers to.

    Of equal payloads of at least `LEAST_REVISIT` bytes the row of the smallest
    page id is the response (a missing id comes last, equal rows in any order).
    Payloads below that size are small enough to be kept here.
    """
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    slim = stage(
        pages.select(
            F.col("page_id").cast("long").alias("page_id"),
            F.col("url").cast("string").alias("url"),
            F.octet_length(html).cast("long").alias("size"),
            F.unhex(F.sha2(html, 256)).alias("digest"),
            F.when(F.octet_length(html) < LEAST_REVISIT, html).alias("body"),
            F.monotonically_increasing_id().alias("tie"),
        ),
        "warc-slim",
    )
    key = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "tie", "url")
    first = (
        slim.filter(F.col("size") >= LEAST_REVISIT)
        .groupBy("digest")
        .agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    joined = slim.join(stage(first, "warc-first"), "digest", "left")
    again = F.col("first.tie") != F.col("tie")
    return joined.select(
        "page_id",
        "url",
        "size",
        "digest",
        "body",
        "tie",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first.page_id")).alias("refers_to"),
        F.when(again, F.col("first.url")).alias("refers_url"),
    )


def _header_value(text: str | None) -> str:
    """A text fit for a header line: control characters and spaces are percent-encoded."""
    shown = "urn:none" if text is None else text
    return "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in shown)


def record_id(page_id: int | None, digest: bytes) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}:{digest.hex()}')}>"


def record(row: dict, payload: bytes | None, place: str) -> bytes:
    """One WARC/1.1 record; lengths and digests are computed anew from what is written."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['size']}\r\n\r\n"
    block = http.encode() + (payload or b"")
    if row["size"] >= LEAST_REVISIT and row["record_type"] == "response":
        name = record_id(row["page_id"], row["digest"])
    else:
        name = f"<urn:uuid:{uuid.uuid5(_SPACE, place)}>"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: {name}",
        f"WARC-Target-URI: {_header_value(row['url'])}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{row['digest'].hex()}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if row["page_id"] is not None:
        lines.append(f"X-Page-Id: {row['page_id']}")
    if row["record_type"] == "revisit":
        lines += [
            f"WARC-Profile: {PROFILE}",
            f"WARC-Refers-To: {record_id(row['refers_to'], row['digest'])}",
            f"WARC-Refers-To-Target-URI: {_header_value(row['refers_url'])}",
            f"WARC-Refers-To-Date: {DATE}",
        ]
        if row["refers_to"] is not None:
            lines.append(f"X-Refers-To-Page-Id: {row['refers_to']}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "replace") + block + b"\r\n\r\n"


class _Roller:
    """The files of one shard: written under temporary names, rolled by compressed size."""

    def __init__(self, folder: str, shard: int, roll_bytes: int) -> None:
        self.fs, self.folder = arrow_fs.FileSystem.from_uri(folder)
        self.shard, self.roll_bytes, self.seq, self.out = shard, roll_bytes, 0, None
        self.done: list[dict] = []

    def write(self, make) -> None:
        if self.out is None:
            name = f"pages-{self.shard:05d}-{self.seq:05d}.warc.gz"
            self.row = {"shard": self.shard, "seq": self.seq, "name": name, "records": 0, "bytes": 0}
            self.row["temporary"] = f"_temporary/{name}.{uuid.uuid4().hex}"
            self.sha = hashlib.sha256()
            self.out = self.fs.open_output_stream(f"{self.folder}/{self.row['temporary']}", compression=None)
            self._add(
                f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid5(_SPACE, name)}>\r\n"
                f"WARC-Date: {DATE}\r\nWARC-Filename: {name}\r\nContent-Type: application/warc-fields\r\n"
                "Content-Length: 23\r\n\r\nformat: WARC File v1.1\n\r\n\r\n".encode()
            )
        self._add(make(f"{self.row['name']}:{self.row['records']}"))
        self.row["records"] += 1
        if self.row["bytes"] >= self.roll_bytes:
            self.close()

    def _add(self, data: bytes) -> None:
        packed = gzip.compress(data, LEVEL, mtime=0)
        self.out.write(packed)
        self.sha.update(packed)
        self.row["bytes"] += len(packed)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append(self.row | {"sha256": self.sha.hexdigest()})
            self.out, self.seq = None, self.seq + 1


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    names = batch.schema.names
    for values in zip(*[column.to_pylist() for column in batch.columns], strict=True):
        yield dict(zip(names, values, strict=True))


def _manifest_batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"shard": pa.int32(), "seq": pa.int32(), "records": pa.int64(), "bytes": pa.int64()}
    names = ["shard", "seq", "name", "temporary", "records", "bytes", "sha256"]
    schema = pa.schema([(name, kinds.get(name, pa.string())) for name in names])
    return pa.RecordBatch.from_pylist(rows, schema)


def write_archives(
    pages: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES
) -> DataFrame:
    """Archives of `pages` (`page_id`, `url`, `html`; other columns are not read) in a new folder.

    Returns the manifest: one row per file. Missing html is an empty payload; a
    missing url is written as `urn:none`; records without a page id carry none.
    An empty table gives no file and an empty manifest. Rerunning on the same
    rows gives the same bytes.
    """
    spark = pages.sparkSession
    order = ["page_id", "digest", "tie"]
    kept = F.when(F.col("record_type") == "response", F.col("size")).otherwise(F.lit(0)) + HEADER_BYTES
    stored = cut(classified(pages).withColumn("kept", kept), order, "warc-cut")
    total = stored.agg(F.sum("kept")).first()[0] or 0
    shard_bytes = max(shard_bytes, -(-total // MAX_SHARDS))
    placed = positions(stored, order, F.col("kept")).withColumn(
        "shard", F.floor(F.col("_before") / F.lit(shard_bytes)).cast("int")
    )
    placed = stage(placed.drop("_row", "_before", "kept"), "warc-placed")
    borders = placed.groupBy("shard").agg(F.min(F.struct("page_id", "digest")).alias("key")).orderBy("shard").collect()
    shards = [row.shard for row in borders]  # at most MAX_SHARDS + 1

    def sortable(page_id: int | None, digest: bytes) -> tuple[bool, int, bytes]:
        return (page_id is not None, page_id or 0, bytes(digest))

    starts = [sortable(*row.key) for row in borders]

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Payloads with the shard that may write them; those that a smaller id of the task makes a revisit stay."""
        least: dict[bytes, tuple] = {}
        for batch in batches:
            places, picks = [], []
            ids, digests = batch.column("page_id").to_pylist(), batch.column("digest").to_pylist()
            for i, (page_id, digest) in enumerate(zip(ids, digests, strict=True)):
                rank = (page_id is None, page_id or 0)
                if digest in least and least[digest] <= rank:
                    continue
                least[digest] = rank
                key = sortable(page_id, digest)
                at = bisect.bisect_left(starts, key)  # the first occurrence lies before or at this border
                near = {max(at - 1, 0)} | ({at} if starts[at : at + 1] == [key] else set())
                for s in near:
                    picks.append(i)
                    places.append(shards[s])
            if picks:
                taken = batch.take(pa.array(picks, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(places, pa.int32()), *taken.columns], ["shard", *taken.schema.names]
                )

    html = F.col("html").cast("binary")
    payloads = (
        pages.select(
            F.col("page_id").cast("long").alias("page_id"), F.unhex(F.sha2(html, 256)).alias("digest"), html.alias("html")
        )
        .filter(F.octet_length("html") >= LEAST_REVISIT)
        .mapInArrow(sent, "shard int, page_id long, digest binary, html binary")
    )
    lines = placed.withColumn("kind", F.lit(1)).unionByName(
        payloads.select("shard", "page_id", "digest", F.col("html").alias("body"), F.lit(0).alias("kind")),
        allowMissingColumns=True,
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, key, payload = None, None, None
        for batch in batches:
            for row in _rows(batch):
                if roller is None or roller.shard != row["shard"]:
                    if roller is not None:
                        roller.close()
                        yield _manifest_batch(roller.done)
                    roller = _Roller(folder, row["shard"], roll_bytes)
                if row["kind"] == 0:
                    key, payload = (row["page_id"], row["digest"]), row["body"]
                    continue
                body = row["body"]
                if row["record_type"] == "response" and row["size"] >= LEAST_REVISIT:
                    if key != (row["page_id"], row["digest"]):
                        raise ValueError(f"no payload for page {row['page_id']}")
                    body = payload
                roller.write(lambda place, row=row, body=body: record(row, body, place))
        if roller is not None:
            roller.close()
            yield _manifest_batch(roller.done)

    parts = max(shards, default=0) + 1  # numbers are left out only behind a page larger than a shard
    files, top = arrow_fs.FileSystem.from_uri(folder)
    files.create_dir(f"{top}/_temporary", recursive=True)
    sorted_lines = lines.repartitionById(parts, F.col("shard")).sortWithinPartitions("shard", "page_id", "digest", "kind", "tie")
    made = stage(sorted_lines.mapInArrow(write, MANIFEST), "warc-manifest")

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, top = arrow_fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in _rows(batch):
                end = f"{top}/{row['name']}"
                if archive.get_file_info(end).type == arrow_fs.FileType.NotFound:  # else an earlier attempt renamed it
                    archive.move(f"{top}/{row['temporary']}", end)
            yield batch

    done = made.repartition(parts).mapInArrow(commit, MANIFEST)
    done.write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest").drop("temporary")


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of all files of a manifest; payloads are checked against their digests."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, top = arrow_fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                with files.open_input_stream(f"{top}/{name}", compression=None) as stream:
                    rows = []
                    for data in members(stream):
                        row = parse(data)
                        if row is not None:
                            rows.append(row if payloads else row | {"payload": None})
                        if len(rows) == 500:
                            yield pa.RecordBatch.from_pylist(rows, _RECORD)
                            rows = []
                    yield pa.RecordBatch.from_pylist(rows, _RECORD)

    return manifest.select("name").repartition(max(1, manifest.count())).mapInArrow(read, RECORD)


_RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def members(stream) -> Iterator[bytes]:
    """The unpacked gzip members of a stream, one at a time."""
    left, unpack, parts = b"", zlib.decompressobj(31), []
    while chunk := left or stream.read(1 << 18):
        parts.append(unpack.decompress(chunk))
        left = b""
        if unpack.eof:
            left = unpack.unused_data
            yield b"".join(parts)
            unpack, parts = zlib.decompressobj(31), []
    if parts:
        raise ValueError("the last member is cut off")


def parse(data: bytes) -> dict | None:
    """A page's record; None for any other type."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    kind = fields["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(b": ", 1) for line in http.split(b"\r\n")[1:])[b"Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    page_id, refers_to = fields.get("X-Page-Id"), fields.get("X-Refers-To-Page-Id")
    return {
        "page_id": None if page_id is None else int(page_id),
        "url": fields["WARC-Target-URI"],
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": None if refers_to is None else int(refers_to),
        "payload": payload if kind == "response" else None,
    }
