import base64
import hashlib
import uuid

from tracemill.llm.warc import read_records, write_pages
from tracemill.session import shared_dir

PAGES = [(5, "http://a/5", "same"), (3, "http://a/3", "same"), (9, None, "same"), (4, "http://a/\n4", None), (6, "u", ""),
         (None, "null id", "alone"), (7, "u", "é" * 1000), (8, "u", "x" * 300000), (2, "u", "rep"), (2, "u", "rep")]


def written(spark, rows, **options):
    base = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, digest string, payload string")
    manifest = write_pages(pages, base, **options)
    return base, manifest


def test_round_trip(spark):
    base, manifest = written(spark, PAGES, roll_bytes=300, shard_bytes=100000)
    assert manifest.count() > 3
    got = {(r.page_id, r.url): r for r in read_records(spark, base).collect()}
    for page_id, url, html in PAGES:
        r = got[page_id, " ".join(url.split()) if url else "about:blank"]
        data = (html or "").encode()
        assert r.payload_bytes == len(data)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == data
    kinds = sorted((r.page_id or -1, r.record_type, r.refers_to) for r in read_records(spark, base).collect())
    assert (3, "response", None) in kinds and (5, "revisit", 3) in kinds and (9, "revisit", 3) in kinds
    assert (4, "response", None) in kinds and (6, "revisit", 4) in kinds
    assert (2, "response", None) in kinds and (2, "revisit", 2) in kinds


def test_short_payloads_are_no_revisits(spark):
    base, _ = written(spark, PAGES, min_payload=5)
    assert {r.record_type for r in read_records(spark, base).collect()} == {"response"}


def test_same_bytes_each_time(spark):
    shas = [sorted((r.final_name, r.sha256) for r in written(spark, PAGES[:5], roll_bytes=300)[1].collect()) for _ in range(2)]
    assert shas[0] == shas[1]


def test_no_pages(spark):
    base, manifest = written(spark, [])
    assert manifest.count() == 0 and read_records(spark, base).count() == 0
