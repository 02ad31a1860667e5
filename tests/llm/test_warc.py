from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections import defaultdict

from leafmill.llm import warc as W


def pages(spark, rows):
    return spark.createDataFrame(
        [(*r, "x", 1) for r in rows], "page_id long, url string, html string, told string, shard int"
    )


def plain(rows, least=0):
    by = defaultdict(list)
    for i, _, h in rows:
        by[(h or "").encode()].append(i)
    out = []
    for payload, ids in by.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        last = max((i for i in ids if i is not None), default=None)
        free = len(payload) < least
        seen = False
        for i in ids:
            response = free or (i == last and not seen)
            seen = seen or (response and not free)
            out.append((i, len(payload), digest, "response" if response else "revisit", None if response else last))
    return sorted(out, key=str)


def told(df):
    return sorted(
        [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect()],
        key=str,
    )


ROWS = [
    (1, "http://a/", "<p>one</p>"), (2, "http://b/\r\nX-Evil: 1", "<p>one</p>"), (3, None, "<p>one</p>"), (4, "u", None),
    (5, "u", ""), (6, "http://é/", "ünï 😀\r\n\r\nWARC/1.1\r\n"), (6, "http://é/", "ünï 😀\r\n\r\nWARC/1.1\r\n"),
    (None, "n", "alone"), (None, "n", "<p>one</p>"), (7, "big", "y" * 300_000),
]


def place():
    from pyspark.sql import SparkSession

    from leafmill.scratch import scratch

    return scratch(SparkSession.active(), f"warc-{uuid.uuid4().hex}")


def test_round_trip_of_edge_cases(spark):
    df = pages(spark, ROWS)
    manifest = W.write_warc(df, place(), shards=3)
    read = W.read_warc(spark, manifest)
    assert told(read) == plain(ROWS)
    held = {r["payload_digest"]: bytes(r["payload"]) for r in read.collect() if r["record_type"] == "response"}
    assert {h or "" for _, _, h in ROWS} == {p.decode() for p in held.values()}
    urls = {r["page_id"]: r["url"] for r in read.collect()}
    assert urls[3] is None and urls[2] == "http://b/%0D%0AX-Evil: 1" and urls[6] == "http://é/"
    assert W.read_warc(spark, W.write_warc(df.limit(0), place())).count() == 0


def test_small_payloads_never_refer(spark):
    df = pages(spark, ROWS)
    assert told(W.read_warc(spark, W.write_warc(df, place(), min_bytes=5))) == plain(ROWS, 5)


def test_same_table_gives_same_files(spark, prose):
    rows = [(i * 37 % 500, f"http://h/{i}", prose(40) if i % 4 else "same") for i in range(500)]
    sums = []
    for parts in (1, 7):
        manifest = W.write_warc(pages(spark, rows).repartition(parts), place(), shards=4, max_file_bytes=8_000)
        files = spark.read.parquet(manifest).orderBy("path").collect()
        sums.append([(r["path"].rpartition("/")[2], r["records"], r["sha1"]) for r in files])
        for r in files:
            data = open(W.file_system(r["path"])[1], "rb").read()
            assert hashlib.sha1(data).hexdigest() == r["sha1"] and gzip.decompress(data).startswith(b"WARC/1.1")
        assert told(W.read_warc(spark, manifest)) == plain(rows)
        assert len({r["shard"] for r in files}) == 4 and max(r["file_no"] for r in files) > 0
        ids = [(r["shard"], r["file_no"]) for r in files]
        assert ids == sorted(ids)
    assert sums[0] == sums[1]
