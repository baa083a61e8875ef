import hashlib
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from scdflow.llm import warc
from scdflow.sources.shared import new_folder

from .helpers import table

SCHEMA = "page_id long, url string, html string"


def archived(spark, pages):
    folder = new_folder(spark, "warc")
    warc.write(pages, folder)
    return folder, warc.records(spark, folder)


def check(rows, got):
    """`rows` of (page_id, url, html) against records read back."""
    best = {}
    for page_id, _, html in rows:
        payload = (html or "").encode()
        if len(payload) >= warc.LEAST and page_id is not None:
            best[payload] = max(page_id, best.get(payload, page_id))
    want = []
    for page_id, url, html in rows:
        payload = (html or "").encode()
        other = best.get(payload)
        revisit = other is not None and page_id != other
        want.append((page_id, url, payload, "revisit" if revisit else "response", other if revisit else None))
    key = str
    found = [(r["page_id"], r["url"], bytes(r["payload"]), r["record_type"], r["refers_to"]) for r in got]
    assert sorted(found, key=key) == sorted(want, key=key)
    for r in got:
        record = bytes(r["record"])
        head, _, body = record.partition(b"\r\n\r\n")
        length = int(re.search(rb"\r\nContent-Length: (\d+)$", head)[1])
        assert head.startswith(b"WARC/1.1\r\n") and len(body) == length + 4 and body.endswith(b"\r\n\r\n")
        digest = hashlib.sha1(bytes(r["payload"])).hexdigest().encode()
        assert b"\r\nWARC-Payload-Digest: sha1:" + digest + b"\r\n" in head
        if r["record_type"] == "response":
            assert body[:-4].partition(b"\r\n\r\n")[2] == bytes(r["payload"])


def test_pages(spark):
    pages = table(spark, "pages").select("page_id", "url", "html")
    _, records = archived(spark, pages.unionAll(pages.withColumn("page_id", F.col("page_id") + 10_000)))
    rows = [tuple(r) for r in pages.collect()]
    check(rows + [(i + 10_000, u, h) for i, u, h in rows], records.collect())


def test_odd_rows(spark):
    long, short = "é" * 500, "a" * 999
    rows = [
        (1, "http://a/", long), (5, None, long), (3, "", long), (None, "http://n/", long), (7, "http://a/", short),
        (8, "http://a/", short), (9, "x", None), (10, "x", ""), (11, "u", "\r\n\r\nContent-Length: 3\r\n" * 60),
        (12, "http://é/ü", "b" * 3_000_000), (13, "z", "b" * 3_000_000), (13, "z", "b" * 3_000_000),
        (None, "q", "only null " * 200), (-4, "neg", "n" * 1000), (-9, "neg", "n" * 1000),
    ]
    pages = spark.createDataFrame(rows, SCHEMA).withColumns(
        {"digest": F.lit("d"), "payload": F.lit("p"), "length": F.lit(1), "header": F.lit(2)}
    )
    folder, records = archived(spark, pages)
    check(rows, records.collect())
    blobs = spark.read.parquet(f"{folder}/payloads")
    assert blobs.count() == len({h or "" for _, _, h in rows})


def test_line_breaks_stay_out_of_the_header(spark):
    _, records = archived(spark, spark.createDataFrame([(1, "http://a/\r\nWARC-Type: x", "b")], SCHEMA))
    assert [r["url"] for r in records.collect()] == ["http://a/%0D%0AWARC-Type: x"]


def test_missing_and_corrupt_payloads_are_errors(spark):
    folder = new_folder(spark, "warc")
    warc.write(spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], SCHEMA), folder)
    blobs = spark.read.parquet(f"{folder}/payloads")
    for bad in (blobs.limit(1), blobs.withColumn("payload", F.encode(F.lit("z"), "UTF-8"))):
        other = new_folder(spark, "warc")
        spark.read.parquet(f"{folder}/records").write.parquet(f"{other}/records")
        bad.write.parquet(f"{other}/payloads")
        with pytest.raises(PySparkException):
            warc.records(spark, other).collect()


def test_empty(spark):
    assert archived(spark, spark.createDataFrame([], SCHEMA))[1].count() == 0
