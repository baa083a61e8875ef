r"""WARC records in a content-addressed archive: two tables written with Spark.

    payloads   `digest` (SHA-256 of the payload, hex), `payload`: each payload once
    records    `page_id`, `digest`, `header`: the exact bytes of each record before its payload

A record's bytes are its header, its payload unless it is a revisit, and `\r\n\r\n`. `records`
joins both tables by digest and checks length and digest of each payload: what is read back is
what was written, or it fails.

Of records with equal payloads of at least `least` bytes, the one with the largest page_id is the
response and all others are revisits of it; smaller payloads are always responses. Rows that are
wholly equal (page, URL, payload) stay separate records; if they have the largest page_id, all of
them are responses, and their payload is stored once like any other.

A null payload is empty; a null URL has no WARC-Target-URI; a null page_id has no WARC-Page-ID
and comes first, so it is a response only where no page_id is known.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scdflow.sources.shared import staged


#: Bytes of the smallest payload that a revisit record may stand for.
LEAST = 1000
RESPONSE, REVISIT = "response", "revisit"
#: Date of all records: the tables have none, and reruns must write the same bytes.
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def write(pages: DataFrame, folder: str, least: int = LEAST) -> None:
    """Archive `page_id`, `url` and `html` of all pages in `folder`."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    digest = F.sha2("payload", 256).alias("digest")
    # Payloads are dealt by digest: equal ones meet before the shuffle, then once more.
    blobs = rows.select(digest, "payload").groupBy("digest").agg(F.first("payload").alias("payload"))
    blobs.write.option("compression", "zstd").parquet(f"{folder}/payloads")
    narrow = staged(
        rows.select(
            "page_id",
            "url",
            digest,
            F.octet_length("payload").cast("long").alias("length"),
            F.sha1("payload").alias("sha1"),
        ),
        "digests",
    )
    first = (
        narrow.filter(F.col("length") >= least)
        .groupBy(F.col("digest").alias("of_digest"))
        .agg(F.max("page_id").alias("response_id"))
    )
    typed = narrow.join(first, F.col("digest") == F.col("of_digest"), "left").drop("of_digest")
    revisits = F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    typed = typed.withColumn("refers_to", F.when(revisits, F.col("response_id")))
    records = typed.select("page_id", "digest", F.encode(_header(), "UTF-8").alias("header"))
    records.write.option("compression", "zstd").parquet(f"{folder}/records")


def _header() -> Column:
    """Header of a record of `page_id, url, digest, length, sha1, refers_to`, as text."""
    revisit = F.col("refers_to").isNotNull()
    page = F.col("page_id").cast("string")
    other = F.col("refers_to").cast("string")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("length").cast("string"),
        F.lit("\r\n\r\n"),
    )
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("length"))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, REVISIT).otherwise(RESPONSE)),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(page)),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), _one_line(F.col("url"))),
        F.concat(F.lit("WARC-Page-ID: "), page),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.concat(F.lit("WARC-Refers-To: "), F.when(revisit, _record_id(other))),
        F.concat(F.lit("WARC-Refers-To-Page-ID: "), other),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), block.cast("string")),
    ]
    # concat_ws leaves out the null lines.
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), http)


def _record_id(page: Column) -> Column:
    h = F.md5(F.concat(F.lit("page:"), F.coalesce(page, F.lit(""))))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _one_line(url: Column) -> Column:
    """Line breaks would end the header's line; they are percent-encoded, as in a URL."""
    return F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def records(spark: SparkSession, folder: str) -> DataFrame:
    """`(page_id, record_type, refers_to, url, header, payload, record)` of each record.

    `payload` is the full payload, of a revisit too; `record` has the bytes of the WARC record.
    A payload that is missing or does not have the header's length and digest raises an error.
    """
    heads = spark.read.schema("page_id long, digest string, header binary").parquet(
        f"{folder}/records"
    )
    blobs = spark.read.schema("digest string, payload binary").parquet(f"{folder}/payloads")
    checked = blobs.select(
        F.col("digest").alias("of_digest"),
        F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload"))
        .otherwise(F.raise_error(F.concat(F.lit("corrupt payload "), "digest")).cast("binary"))
        .alias("payload"),
    )
    joined = heads.join(checked, F.col("digest") == F.col("of_digest"), "left")
    text = F.decode("header", "UTF-8")
    length = F.regexp_extract(text, r"\r\n\r\n(?s:.*)\r\nContent-Length: (\d+)\r\n", 1).cast("long")
    whole = (F.octet_length("payload") == length) & (
        F.sha1("payload") == _field(text, "WARC-Payload-Digest: sha1:")
    )
    payload = F.when(whole, F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("wrong payload for "), text)).cast("binary")
    )
    end = F.encode(F.lit("\r\n\r\n"), "UTF-8")
    kind = _field(text, "WARC-Type: ")
    return joined.select(
        _field(text, "WARC-Page-ID: ").cast("long").alias("page_id"),
        kind.alias("record_type"),
        _field(text, "WARC-Refers-To-Page-ID: ").cast("long").alias("refers_to"),
        _field(text, "WARC-Target-URI: ").alias("url"),
        "header",
        payload.alias("payload"),
        F.when(kind == REVISIT, F.concat("header", end))
        .otherwise(F.concat("header", "payload", end))
        .alias("record"),
    )


def _field(header: Column, name: str) -> Column:
    """What follows `name` in a line of the WARC header; null if no line has it."""
    found = F.regexp_extract(header, rf"^(?s:.*?)\r\n{name}([^\r]*)\r\n", 1)
    return F.when(F.contains(header, F.lit(f"\r\n{name}")), found)
