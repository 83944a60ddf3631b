"""Deterministic sharded WARC writer and the reader for its archives.

Records are range-sorted by id. One task writes one shard: a sequence of files,
each closed once its compressed size passes ``roll_bytes``; every record is a gzip
member of its own. Headers and digests are made anew from the payload. Files get a
temporary name that no other attempt uses; the table of written files is committed
by Spark, and only the files it lists are renamed, so a lost or repeated task
leaves no half-written archive under a final name. The manifest is written last.

A page whose payload has at least ``min_payload`` bytes and equals that of a page
with a smaller id becomes a ``revisit`` of the smallest such id and stores no payload.

Defined cases: a null payload is empty; a null url becomes ``about:blank``; pages with
a null id sort first and never are the smallest of a group that has another id; of
rows with equal id and equal payload the first is the response, the others revisit
that same id; an empty table gives a manifest without rows and no files.
"""

from __future__ import annotations

import base64
import hashlib
import math
import uuid
import zlib

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.llm.common import table
from tracemill.session import materialise, shared_dir

#: WARC-Date of every record; a fixed date keeps the archives equal byte by byte.
DATE = "2024-01-01T00:00:00Z"
MANIFEST = "shard int, seq int, temp_name string, final_name string, n_records long, n_bytes long, sha256 string"
RECORDS = ("page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
           "record_type string, refers_to long")


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}:{digest}')}>"


def _member(headers: list[tuple[str, object]], block: bytes, level: int) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers if v is not None)
    raw = head.encode() + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def _one_line(url: str | None) -> str:
    return " ".join(url.split()) if url else "about:blank"


def _filesystem(base: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(base)


def page_record(page_id, url, payload: bytes, refers_to, is_revisit: bool, level: int) -> bytes:
    digest = _digest(payload)
    headers = [("WARC-Type", "revisit" if is_revisit else "response"), ("WARC-Record-ID", _record_id(page_id, digest)),
               ("WARC-Date", DATE), ("WARC-Target-URI", _one_line(url)), ("WARC-Payload-Digest", f"sha1:{digest}"),
               ("Content-Type", "application/http;msgtype=response"), ("Page-Id", page_id),
               ("Page-Payload-Length", len(payload))]
    if is_revisit:
        headers += [("WARC-Refers-To", _record_id(refers_to, digest)), ("Page-Refers-To", refers_to),
                    ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return _member(headers, http if is_revisit else http + payload, level)


class _Roller:
    """Writes records to files ``shard-seq`` and closes a file once it is large enough."""

    def __init__(self, base: str, shard: int, roll_bytes: int, level: int):
        self.fs, self.root = _filesystem(base)
        self.fs.create_dir(f"{self.root}/temp", recursive=True)
        self.shard, self.roll_bytes, self.level = shard, roll_bytes, level
        self.seq, self.out, self.done = 0, None, []

    def add(self, record: bytes) -> None:
        if self.out is None:
            self.final = f"part-{self.shard:06d}-{self.seq:05d}.warc.gz"
            self.temp = f"{self.final}.{uuid.uuid4().hex}"
            self.out = self.fs.open_output_stream(f"{self.root}/temp/{self.temp}", compression=None)
            self.size, self.records, self.sha = 0, 0, hashlib.sha256()
            info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(None, self.final)), ("WARC-Date", DATE),
                    ("WARC-Filename", self.final), ("Content-Type", "application/warc-fields")]
            self._put(_member(info, b"format: WARC File Format 1.1\r\n", self.level))
        self._put(record)
        self.records += 1
        if self.size >= self.roll_bytes:
            self.close()

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.size += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.shard, self.seq, self.temp, self.final, self.records, self.size, self.sha.hexdigest()))
            self.seq, self.out = self.seq + 1, None


def _shard_writer(base: str, roll_bytes: int, min_payload: int, level: int):
    names = [f.split()[0] for f in MANIFEST.split(", ")]

    def write(batches):
        roller = _Roller(base, TaskContext.get().partitionId(), roll_bytes, level)
        current, refers, seen = object(), {}, set()
        for batch in batches:
            for page_id, is_page, url, payload, digest, refers_to in zip(
                    *(batch[c].tolist() for c in ("page_id", "is_page", "url", "payload", "digest", "refers_to"))):
                page_id = None if pd.isna(page_id) else int(page_id)
                if page_id != current:
                    current, refers, seen = page_id, {}, set()
                if not is_page:
                    refers[digest] = None if pd.isna(refers_to) else int(refers_to)
                    continue
                data = bytes(payload)
                own = hashlib.sha1(data).hexdigest()
                to = refers.get(own, page_id)
                revisit = len(data) >= min_payload and (own in refers or own in seen)
                seen.add(own)
                roller.add(page_record(page_id, url, data, to, revisit, level))
        roller.close()
        yield pd.DataFrame(roller.done, columns=names)

    return write


def _committer(base: str):
    def rename(batches):
        from pyarrow.fs import FileType

        fs, root = _filesystem(base)
        fs.create_dir(f"{root}/warc", recursive=True)
        for batch in batches:
            for temp, final in zip(batch["temp_name"], batch["final_name"]):
                if fs.get_file_info(f"{root}/temp/{temp}").type == FileType.File:  # else an earlier attempt moved it
                    fs.move(f"{root}/temp/{temp}", f"{root}/warc/{final}")
            yield batch

    return rename


def write_pages(pages: DataFrame, base: str, min_payload: int = 0, roll_bytes: int = 8 << 20,
                shard_bytes: int = 32 << 20, level: int = 6, id_col: str = "page_id", url_col: str = "url",
                payload_col: str = "html") -> DataFrame:
    """Write ``pages`` below ``base``; returns the manifest, one row per committed file."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    digests = materialise(pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.sha1(payload).alias("digest"), F.octet_length(payload).alias("n_bytes")))
    total = digests.agg(F.sum("n_bytes")).first()[0] or 0
    groups = (digests.filter(F.col("n_bytes") >= min_payload).groupBy("digest")
              .agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    later = (digests.filter(F.col("n_bytes") >= min_payload).join(groups, "digest")
             .filter(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "digest", "refers_to").distinct())
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.lit(True).alias("is_page"), F.col(url_col).alias("url"),
        F.encode(payload, "UTF-8").alias("payload"), F.lit(None).cast("string").alias("digest"),
        F.lit(None).cast("long").alias("refers_to"))
    marks = later.select("page_id", F.lit(False).alias("is_page"), F.lit(None).cast("string").alias("url"),
                         F.lit(None).cast("binary").alias("payload"), "digest", "refers_to")
    shards = max(1, math.ceil(total / shard_bytes))
    ordered = (rows.unionByName(marks).repartitionByRange(shards, "page_id")
               .sortWithinPartitions("page_id", "is_page", "url", "payload"))
    written = materialise(ordered.mapInPandas(_shard_writer(base, roll_bytes, min_payload, level), MANIFEST))
    committed = written.repartition(min(shards, 200)).mapInPandas(_committer(base), MANIFEST)
    committed.write.mode("overwrite").parquet(f"{base}/manifest")
    return pages.sparkSession.read.schema(MANIFEST).parquet(f"{base}/manifest")


def _members(data: bytes):
    """The uncompressed members of a gzip file, one after the other."""
    while data:
        unpacker = zlib.decompressobj(31)
        yield unpacker.decompress(data) + unpacker.flush()
        data = unpacker.unused_data


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return headers, rest[: int(headers["Content-Length"])]


def _read_files(with_payload: bool):
    def whole(value):
        return None if value is None else int(value)

    def read(batches):
        for batch in batches:
            for content in batch["content"]:
                out = []
                for raw in _members(bytes(content)):
                    headers, block = parse_record(raw)
                    kind = headers["WARC-Type"]
                    if kind not in ("response", "revisit"):
                        continue
                    payload = block.partition(b"\r\n\r\n")[2]
                    digest, size = headers["WARC-Payload-Digest"].removeprefix("sha1:"), int(headers["Page-Payload-Length"])
                    if kind == "response" and (_digest(payload), len(payload)) != (digest, size):
                        raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
                    out.append((whole(headers.get("Page-Id")), headers["WARC-Target-URI"],
                                payload if with_payload and kind == "response" else None, size, digest, kind,
                                whole(headers.get("Page-Refers-To"))))
                frame = pd.DataFrame(out, columns=[f.split()[0] for f in RECORDS.split(", ")])
                yield frame.astype({"page_id": "Int64", "refers_to": "Int64"})

    return read


def read_records(spark: SparkSession, base: str, with_payload: bool = True) -> DataFrame:
    """The response and revisit records below ``base``; digests of payloads are checked."""
    if spark.read.schema(MANIFEST).parquet(f"{base}/manifest").isEmpty():
        return spark.createDataFrame([], RECORDS)
    files = spark.read.format("binaryFile").load(f"{base}/warc").select("content")
    return files.mapInPandas(_read_files(with_payload), RECORDS)


def op9_warc(spark, sf_dir):
    base = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_pages(table(spark, sf_dir, "pages"), base, min_payload=0)
    return read_records(spark, base, with_payload=False).drop("url", "payload")


ORACLE = """
WITH hashed AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hexed FROM pages),
digits AS (
  SELECT *, list_transform(range(8), lambda g: ('0x' || substr(hexed, (5 * g + 1)::BIGINT, 5))::BIGINT) AS parts FROM hashed),
named AS (
  SELECT *, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((parts[(i // 4) + 1] >> (15 - 5 * (i % 4))::INT) & 31) + 1)::BIGINT, 1)), '') AS payload_digest,
    min(page_id) OVER (PARTITION BY hexed) AS first_id FROM digits)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM named
"""
