"""Content-addressed WARC archive.

An archive is two Parquet tables in one folder. ``payloads`` holds each
distinct payload once, under its SHA-256; ``headers`` holds the exact header
bytes of every record. Records are put together again by a join on the
digest, which the reader computes anew from the stored bytes.

Everything is built-in functions. The join deals a payload with many records
out to several tasks: headers carry a salt below the number of shares their
payload has, and the payload is repeated once per share. Sizes and digests
are those of the payload of the record as put together, so every query puts
all records together.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktally.llm.common import drop_scratch, materialize
from sparktally.session import scratch_path

REVISIT_BYTES = 100  # payloads from this size on are stored by reference
SHARE_ROWS = 512  # records of one payload per join task
# Names and layout of the WARC format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:page:"
CRLF = "\r\n"


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def _id(page_id: Column) -> Column:
    return F.concat(F.lit(f"<{RECORD_ID}"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def _header(date: str) -> Column:
    """Header text of a record; control characters of a URL are escaped, so a
    header line cannot be broken."""
    revisit = F.col("record_type") == "revisit"
    uri = F.coalesce(F.regexp_replace("url", r"[\x00-\x1f\x7f]", "%20"), F.lit(""))
    return F.concat(
        F.lit(VERSION + CRLF),
        _field("WARC-Type", F.col("record_type")),
        _field("WARC-Record-ID", _id(F.col("page_id"))),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", uri),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, _field("WARC-Refers-To", _id(F.col("first_id")))).otherwise(F.lit("")),
        F.when(revisit, _field("WARC-Profile", F.lit(PROFILE))).otherwise(F.lit("")),
        _field("Content-Type", F.lit("text/html; charset=utf-8")),
        _field("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string"))),
        F.lit(CRLF),
    )


def write_archive(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write a record per row of ``pages`` under ``path``.

    NULL html is an empty payload, NULL url an empty target. Of records with
    equal payloads of 100 bytes or more the smallest page_id is the response
    and the others are revisits of it (a NULL page_id is one only if no other
    row has the payload); a repeated smallest page_id stays a response each
    time. Smaller payloads are responses. Other columns are not archived. An
    empty table gives an empty archive.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), payload.alias("payload")).select(
        "*", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("long").alias("bytes")
    )
    slim = rows.select("page_id", "url", "digest", "bytes")
    firsts = materialize(
        slim.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .select("digest", "first_id", F.ceil(F.col("n") / SHARE_ROWS).cast("int").alias("shares")),
        "warc-firsts",
    )
    again = (F.col("bytes") >= REVISIT_BYTES) & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    headers = slim.join(firsts, "digest").withColumn("record_type", F.when(again, "revisit").otherwise("response"))
    headers.select(
        "digest",
        F.pmod(F.xxhash64("page_id", "url"), F.col("shares")).cast("int").alias("share"),
        "page_id",
        _header(date).cast("binary").alias("header"),
    ).write.option("compression", "zstd").parquet(f"{path}/headers")
    stored = rows.select("digest", "payload").dropDuplicates(["digest"])
    stored.join(firsts.select("digest", "shares"), "digest").write.option("compression", "zstd").parquet(f"{path}/payloads")
    drop_scratch(firsts)


def _header_value(name: str) -> Column:
    value = F.regexp_extract(F.col("head"), rf"(?m)^{name}: ([^\r\n]*)", 1)
    return F.when(value != "", value)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record of an archive: page_id, record_type, refers_to (record id
    or NULL), payload_bytes, payload_digest (of the payload in the record's
    bytes, a revisit's: of the payload it refers to), payload (full, also for
    revisits) and record (the record's exact bytes). A record whose payload is
    missing or does not have the digest that its header names fails the
    read."""
    stored = spark.read.parquet(f"{path}/payloads").select("digest", "shares", "payload")
    shared = stored.withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).drop("shares")
    headers = spark.read.parquet(f"{path}/headers").withColumn("head", F.col("header").cast("string"))
    parsed = headers.select(
        "digest", "share", "page_id", "header",
        _header_value("WARC-Type").alias("record_type"),
        _header_value("WARC-Refers-To").alias("refers_to"),
        F.regexp_extract("head", r"(?m)^WARC-Payload-Digest: sha256:([0-9a-f]*)", 1).alias("named"),
    )
    response = F.col("record_type") == "response"
    end = F.lit(b"\r\n\r\n")
    records = parsed.join(shared, ["digest", "share"], "left").withColumn(
        "record", F.concat(F.col("header"), F.when(response, F.col("payload")).otherwise(F.lit(b"")), end)
    )
    length = F.octet_length("record") - F.octet_length("header") - F.octet_length(end)
    body = F.when(response, F.substring("record", F.octet_length("header") + 1, length)).otherwise(F.col("payload"))
    named = F.coalesce(F.col("named"), F.lit(""))
    return records.withColumn("body", body).withColumn("found", F.sha2("body", 256)).select(
        "page_id",
        "record_type",
        "refers_to",
        F.octet_length("body").cast("long").alias("payload_bytes"),
        F.when(F.col("found") == named, F.col("found"))
        .otherwise(F.raise_error(F.concat(F.lit("payload is missing or does not have its digest: "), named)))
        .alias("payload_digest"),
        F.col("body").alias("payload"),
        "record",
    )


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write all pages to a new archive in the shared scratch folder and read
    it back: page_id, payload_bytes, payload_digest, record_type, refers_to
    (the response's page_id)."""
    spark = pages.sparkSession
    path = scratch_path(spark, f"warc-{uuid.uuid4().hex}")
    write_archive(pages, path)
    kind = pages.schema["page_id"].dataType
    return read_archive(spark, path).select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.regexp_extract("refers_to", rf"^<{RECORD_ID}(.*)>$", 1).try_cast(kind).alias("refers_to"),
    )


ARCHIVE_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages
), d AS (
  SELECT page_id, strlen(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""
