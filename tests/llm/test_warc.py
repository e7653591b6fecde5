import gzip
import hashlib
import os
import re

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import queries, warc

DATA = "/root/testdata/sf0.001"


def brute(rows):
    """page_id, size, digest, type, refers_to of each page, in sorted order."""
    payloads = [(i, (html or "").encode()) for i, _, html in rows]
    least = {}
    for i, data in payloads:
        key = (i is None, i or 0)
        if len(data) >= 100:
            least[data] = min(key, least.get(data, key))
    out, used = [], set()
    for i, data in sorted(payloads, key=lambda p: (p[0] is None, p[0] or 0)):
        again = len(data) >= 100 and ((i is None, i or 0) != least[data] or data in used)
        used.add(data)
        first = least.get(data)
        refers = None if not again or first[0] else first[1]
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", refers))
    return sorted(out, key=repr)


def found(df):
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_brute_force(spark, sf):
    data = f"/root/testdata/{sf}"
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/pages.parquet").select("page_id", "url", "html").collect()]
    assert found(queries.QUERIES["op9_warc"](spark, data)) == brute(rows)


PAGES = (
    [(k, f"http://a/{k}", f"<p>{k}</p>" * 40) for k in range(120)]
    + [(500 + k, f"http://copy/{k}", "<p>copy</p>" * 30) for k in range(60)]
    + [(3, "http://a/again", "<p>copy</p>" * 30), (3, "http://a/again", "<p>copy</p>" * 30)]
    + [(900, None, None), (901, "http://b/\r\nX: y z", ""), (None, "http://c", "short"), (None, "http://c", "long" * 99)]
    + [(902, "http://long", "é" * 400_000), (903, "http://s", "x" * 99), (904, "http://s", "x" * 99)]
)


def pages(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(4)
    return df.withColumn("shard", F.lit("s")).withColumn("digest", F.lit(1)).withColumn("body", F.lit(1))


def archive(spark, folder):
    return warc.write_archives(pages(spark), str(folder), shard_bytes=20_000, roll_bytes=3_000)


def test_round_trip_with_many_shards_and_rolls(spark, tmp_path):
    manifest = archive(spark, tmp_path / "one")
    names = [r.name for r in manifest.collect()]
    assert len({n.split("-")[1] for n in names}) > 3 and any(n.endswith("-00001.warc.gz") for n in names)
    read = warc.read_archives(spark, str(tmp_path / "one"), manifest)
    assert found(read) == brute(PAGES)
    html = {(r.page_id, r.payload_digest): r.payload for r in read.filter("record_type = 'response'").collect()}
    for page_id, _, text in PAGES:
        data = (text or "").encode()
        if (page_id, hashlib.sha256(data).hexdigest()) in html:
            assert html[page_id, hashlib.sha256(data).hexdigest()] == data
    assert sorted(os.listdir(tmp_path / "one" / "_temporary")) == []


def test_reruns_write_the_same_bytes(spark, tmp_path):
    for folder in ("one", "two"):
        archive(spark, tmp_path / folder)
    names = [n for n in os.listdir(tmp_path / "one") if n.endswith(".gz")]
    assert len(names) > 3
    for name in names:
        one, two = ((tmp_path / folder / name).read_bytes() for folder in ("one", "two"))
        assert one == two


def test_files_are_plain_warc(spark, tmp_path):
    manifest = archive(spark, tmp_path / "one").collect()
    for row in manifest:
        data = (tmp_path / "one" / row.name).read_bytes()
        assert len(data) == row.bytes and hashlib.sha256(data).hexdigest() == row.sha256
        plain = gzip.decompress(data)
        at = records = 0
        while at < len(plain):
            head, _, _ = plain[at:].partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\n")
            fields = dict(re.findall(rb"\r\n([\w\-]+): ([^\r]*)", head))
            block = plain[at + len(head) + 4 :][: int(fields[b"Content-Length"])]
            if fields[b"WARC-Type"] != b"warcinfo":
                records += 1
                assert fields[b"WARC-Block-Digest"].decode() == "sha256:" + hashlib.sha256(block).hexdigest()
            at += len(head) + 4 + len(block) + 4
        assert records == row.records


def test_empty_table(spark, tmp_path):
    manifest = warc.write_archives(pages(spark).limit(0), str(tmp_path / "none"))
    assert manifest.count() == 0
    assert warc.read_archives(spark, str(tmp_path / "none"), manifest).count() == 0


def test_a_damaged_payload_is_told(tmp_path):
    row = {"page_id": 1, "url": "u", "size": 4, "digest": hashlib.sha256(b"good").digest(), "record_type": "response"}
    assert warc.parse(warc.record(row, b"good", "x"))["page_id"] == 1
    with pytest.raises(ValueError):
        warc.parse(warc.record(row, b"baad", "x"))
