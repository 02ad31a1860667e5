"""A deterministic sharded WARC writer, and a reader of what it wrote.

Records are range-sorted by page id: cut points come from a sample chosen by the ids' hashes, so the
same table gives the same shards on any cluster.  A shard is written in order and rolled to a new
file once the compressed size reaches the limit.  Headers, record ids and digests are made anew from
the content.  A task writes under a temporary name; the names that Spark's own commit let through
are then moved to their final ones and listed in a manifest, which is all a reader looks at.  So
repeated, lost or speculative tasks leave at most unlisted temporary files.

Files go through pyarrow's file systems, which cover local and mounted folders, HDFS and object
stores by their URI.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import attach

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SAMPLE_PER_SHARD = 200
MANIFEST = "shard long, file_no long, temp string, path string, records long, bytes long, sha1 string"
RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, payload binary"
)


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path and the path in it."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def header_text(value: str) -> str:
    """A value that stays on its header line: control characters are percent-coded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record_id(page: object, digest: str, copy: int = 0) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{digest}:{copy}')}>"


def member(headers: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    """One record as a gzip member of its own, without a time stamp."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers)
    head = f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode()
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(head + block + b"\r\n\r\n") + z.flush()


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def page_member(page, url, payload, digest, copy, response, date, level) -> bytes:
    """The record of a page; ``response`` is the page whose response a revisit refers to, or None."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += f"Content-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if response is None else http
    headers = [
        ("WARC-Type", "response" if response is None else "revisit"),
        ("WARC-Record-ID", record_id(page, digest, copy)),
        ("WARC-Date", date),
        ("WARC-Target-URI", header_text(url) if url else f"urn:page:{page}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if page is not None:
        headers.append(("X-Page-Id", str(page)))
    if url is not None:
        headers.append(("X-Has-Url", "1"))
    if response is not None:
        headers += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", record_id(*response, digest)),
        ]
        if response[0] is not None:
            headers.append(("X-Refers-To-Page-Id", str(response[0])))
    return member(headers, block, level)


class ShardFile:
    """A file under a temporary name, with its digest as it grows."""

    def __init__(self, root: str, shard: int, no: int, date: str, level: int):
        self.shard, self.no, self.records, self.bytes = shard, no, 0, 0
        self.path = f"{root}/shard-{shard:06d}-{no:04d}.warc.gz"
        self.temp = f"{self.path}.{uuid.uuid4().hex}.tmp"
        system, place = file_system(self.temp)
        system.create_dir(place.rpartition("/")[0], recursive=True)
        self.out, self.sha1 = system.open_output_stream(place, compression=None), hashlib.sha1()
        name = self.path.rpartition("/")[2]
        self.put(
            member(
                [
                    ("WARC-Type", "warcinfo"),
                    ("WARC-Record-ID", record_id(name, "")),
                    ("WARC-Date", date),
                    ("WARC-Filename", name),
                    ("Content-Type", "application/warc-fields"),
                ],
                b"format: WARC File Format 1.1\r\n",
                level,
            )
        )

    def put(self, data: bytes) -> None:
        self.out.write(data)
        self.sha1.update(data)
        self.bytes += len(data)

    def close(self) -> tuple:
        self.out.close()
        return (self.shard, self.no, self.temp, self.path, self.records, self.bytes, self.sha1.hexdigest())


def writer(root: str, min_bytes: int, max_file_bytes: int, date: str, level: int):
    """Per task: sorted rows of whole shards to files; a row of the manifest for each file."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in MANIFEST.split(", ")]
        out, last, response, copy = None, None, None, 0
        for df in batches:
            for shard, page, digest, url, payload, told, to in zip(
                df["shard"], df["page"].astype("object"), df["digest"], df["url"], df["payload"],
                df["told"], df["to"].astype("object"), strict=True,
            ):
                page, to = (None if pd.isna(x) else int(x) for x in (page, to))
                key = (page, digest)
                if told:  # what holds for the records that follow
                    last, response, copy = key, (to, page == to), 0
                    continue
                assert key == last, "a record came without its decision"
                if out and (out.shard != shard or out.bytes >= max_file_bytes):
                    yield pd.DataFrame([out.close()], columns=names)
                    out = ShardFile(root, shard, out.no + 1 if out.shard == shard else 0, date, level)
                out = out or ShardFile(root, shard, 0, date, level)
                first = len(payload) < min_bytes or (response[1] and copy == 0)
                code = base64.b32encode(bytes.fromhex(digest)).decode()
                out.put(
                    page_member(
                        page, url, bytes(payload), code, copy, None if first else (response[0],), date, level
                    )
                )
                out.records += 1
                copy += 1
        if out:
            yield pd.DataFrame([out.close()], columns=names)

    return run


def commit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Move finished files to their names; done again, it finds them there."""
    for df in batches:
        for temp, path, size in zip(df["temp"], df["path"], df["bytes"], strict=True):
            system, place = file_system(temp)
            final = file_system(path)[1]
            if system.get_file_info(place).type == pafs.FileType.File:
                system.move(place, final)
            if system.get_file_info(final).size != size:
                raise OSError(f"{path} isn't the file that was written")
        yield df


def cut_points(keys: DataFrame, shards: int) -> list[int]:
    """At most shards - 1 page ids that split the bytes evenly, from ids with small hashes.

    The sample holds about SAMPLE_PER_SHARD ids a shard; it only balances, it decides no record.
    """
    n = keys.count()
    part = min(1 << 20, max(1, -(-(shards * SAMPLE_PER_SHARD << 20) // max(n, 1))))
    picked = keys.where(f"page is not null and pmod(xxhash64(page), {1 << 20}) < {part}")
    some = picked.select("page", "n_bytes").toPandas().sort_values("page")
    if some.empty:
        return []
    done = (some["n_bytes"] + 1).cumsum() / (some["n_bytes"] + 1).sum()
    return sorted({int(some["page"].iloc[done.searchsorted(i / shards)]) for i in range(1, shards)})


def write_warc(
    pages: DataFrame,
    path: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    body_col: str = "html",
    min_bytes: int = 0,
    max_file_bytes: int = 1 << 30,
    shard_bytes: int = 256 << 20,
    shards: int | None = None,
    date: str = "1970-01-01T00:00:00Z",
    level: int = 6,
) -> str:
    """Write a record per row under ``path`` and return the path of the manifest.

    Of equal payloads of at least ``min_bytes`` bytes the one with the largest id is a response,
    the others are revisits of it; of repeated rows the first is.  A null body is empty.  Null ids
    count as smallest and are left out of the headers; null addresses are, too.  Characters that
    would break a header line are percent-coded.  An empty table gives an empty manifest.

    ``shards``: by default one for each ``shard_bytes`` of payload, and no fewer than the session's
    shuffle partitions, so that small tables use the cluster as well.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{body_col}`").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    keys_path = f"{path}/_keys"
    rows.select("page", "digest", F.octet_length("payload").cast("long").alias("n_bytes")).write.parquet(
        keys_path
    )
    keys = spark.read.parquet(keys_path)
    total = keys.agg(F.sum("n_bytes")).first()[0] or 0
    shards = shards or max(-(-total // shard_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = cut_points(keys, shards)

    # One decision for each payload and page; a payload's pages meet only as counted rows.
    each = keys.select("digest", "page").distinct()
    decided_path = f"{path}/_groups"
    each.groupBy("digest").agg(
        F.max("page").alias("to"), F.count(F.lit(1)).alias("pages")
    ).write.parquet(decided_path)
    groups = spark.read.parquet(decided_path)
    total_pages = groups.agg(F.sum("pages")).first()[0] or 0
    each_path = f"{path}/_each"
    each.write.parquet(each_path)
    told = attach(spark.read.parquet(each_path), groups, ["digest"], "pages", total_pages).select(
        "page", "digest", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"),
        F.lit(True).alias("told"), "to",
    )
    both = told.unionByName(
        rows.select("page", "digest", "url", "payload", F.lit(False).alias("told"), F.lit(None).cast("long").alias("to"))
    )
    marks = F.lit(cuts) if cuts else F.array().cast("array<bigint>")
    shard = F.coalesce(F.size(F.filter(marks, lambda c: c < F.col("page"))), F.lit(0))
    files = (
        both.withColumn("shard", shard.cast("int"))
        .repartitionById(len(cuts) + 1, F.col("shard"))
        .sortWithinPartitions("shard", "page", "digest", F.desc("told"))
        .mapInPandas(writer(path, min_bytes, max_file_bytes, date, level), MANIFEST)
    )
    files.write.parquet(f"{path}/_written")
    done = spark.read.parquet(f"{path}/_written").repartition(max(1, shards))
    done.mapInPandas(commit, MANIFEST).drop("temp").write.parquet(f"{path}/manifest")
    return f"{path}/manifest"


def members_of(stream) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    z, out, data = zlib.decompressobj(31), [], b""
    while True:
        data = data or stream.read(1 << 20)
        if not data:
            if out:
                raise EOFError("the archive ends inside a record")
            return
        out.append(z.decompress(data))
        data = z.unused_data
        if z.eof:
            yield b"".join(out)
            z, out = zlib.decompressobj(31), []


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    pairs = (x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    headers = dict(pairs)
    return headers, rest[: int(headers["Content-Length"])]


def reader(with_payload: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in RECORDS.split(", ")]

        def frame(rows: list[tuple]) -> pd.DataFrame:
            df = pd.DataFrame(rows, columns=names)
            return df.astype({"page_id": "Int64", "refers_to": "Int64"})

        for df in batches:
            for path in df["path"]:
                system, place = file_system(path)
                rows, held = [], 0
                with system.open_input_stream(place, compression=None) as stream:
                    for record in members_of(stream):
                        h, block = parse(record)
                        if h["WARC-Type"] == "warcinfo":
                            continue
                        if base32_sha1(block) != h["WARC-Block-Digest"][5:]:
                            raise ValueError(f"a block in {path} doesn't match its digest")
                        digest, payload = h["WARC-Payload-Digest"][5:], None
                        if h["WARC-Type"] == "response":
                            payload = block.partition(b"\r\n\r\n")[2]
                            if base32_sha1(payload) != digest or len(payload) != int(h["X-Payload-Length"]):
                                raise ValueError(f"a payload in {path} doesn't match its digest")
                        page, to = (h.get(k) for k in ("X-Page-Id", "X-Refers-To-Page-Id"))
                        rows.append(
                            (
                                int(page) if page else None,
                                h["WARC-Target-URI"] if "X-Has-Url" in h else None,
                                h["WARC-Type"],
                                int(to) if to else None,
                                int(h["X-Payload-Length"]),
                                digest,
                                payload if with_payload else None,
                            )
                        )
                        held += len(block) * with_payload + 200
                        if held > 8 << 20:
                            yield frame(rows)
                            rows, held = [], 0
                if rows:
                    yield frame(rows)

    return run


def read_warc(spark: SparkSession, manifest: str, *, with_payload: bool = True) -> DataFrame:
    """The records of all files in a manifest, as RECORDS; every digest is checked.

    A revisit has no payload: its response holds it.  Files are read as streams, a record at a time.
    """
    files = spark.read.parquet(manifest).select("path")
    n = max(1, files.count())
    return files.repartition(n).mapInPandas(reader(with_payload), RECORDS)
