"""Content-addressed web archive.

Three written tables make an archive: ``payloads`` holds each payload once under its SHA-256, ``headers`` the
exact header bytes of every record with the digest of its payload, and the join of the two by digest gives the
original records back. The payload table is bucketed by digest, so that join moves headers only.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes, that with the smallest id (null last, then
by address, then by row) is a ``response`` and the others are ``revisit`` records, which refer to it and carry
no payload of their own. Smaller payloads are all responses. A null payload is empty. Reading verifies every
payload against its digest and length and fails on the first that differs.

Records carry the mandatory fields of WARC/1.1; the pages name no capture date, so it is a parameter. A payload is kept
whole, whatever its length. A null id or address has no field and reads back as null, so does an empty address. Rows with
equal ids are records of their own. An empty table makes an empty archive. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloom.llm.common import bucketed, utf8, written

MIN_REVISIT = 100
# Fixed value: how a revisit says that its payload is that of an earlier record.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURED = "1970-01-01T00:00:00Z"
CRLF = "\r\n"
VERSION = "WARC/1.1"


def record_id(row: Column) -> Column:
    """A stable urn made of the row number."""
    digits = F.lpad(F.lower(F.hex(row)), 32, "0")
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *[F.substring(digits, a, n) for a, n in cuts]))


def field(name: str, value: Column) -> Column:
    """A header line; none if the value is null. Line breaks inside values become blanks."""
    return F.concat(F.lit(f"{name}: "), F.regexp_replace(value, "[\\r\\n]", " "), F.lit(CRLF))


def write_archive(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", captured: str = CAPTURED
) -> tuple[DataFrame, DataFrame, str]:
    """The archive of ``pages``: its headers, its payloads and the payloads' folder."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), utf8(html).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    captures = rows.select("page_id", "url", "digest", F.octet_length("payload").cast("long").alias("length"))
    captures = written(captures.withColumn("row", F.monotonically_increasing_id()), "captures")
    once = rows.groupBy("digest").agg(F.first("payload").alias("payload"))
    payloads, path = bucketed(once, "digest", "payloads")

    order = F.struct(F.col("page_id").isNull().alias("last"), "page_id", "url", "row")
    first = captures.filter(F.col("length") >= MIN_REVISIT).groupBy("digest").agg(F.min(order).alias("first"))
    dated = captures.join(first, "digest", "left")
    revisit = F.col("first").isNotNull() & (F.col("first.row") != F.col("row"))
    lines = [
        field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", F.concat(F.lit("<"), record_id(F.col("row")), F.lit(">"))),
        field("WARC-Date", F.lit(captured)),
        field("WARC-Profile", F.when(revisit, PROFILE)),
        field("WARC-Target-URI", F.col("url")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        field("X-Payload-Length", F.col("length").cast("string")),
        field("X-Page-ID", F.col("page_id").cast("string")),
        field("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<"), record_id(F.col("first.row")), F.lit(">")))),
        field("X-Refers-To-Page-ID", F.when(revisit, F.col("first.page_id").cast("string"))),
        field("Content-Length", F.when(revisit, "0").otherwise(F.col("length").cast("string"))),
    ]
    header = F.concat(F.lit(VERSION + CRLF), *[F.coalesce(x, F.lit("")) for x in lines], F.lit(CRLF))
    return written(dated.select("digest", header.cast("binary").alias("header")), "headers"), payloads, path


def read_archive(headers: DataFrame, payloads: DataFrame, payload_path: str) -> DataFrame:
    """Records as written: ``header``, ``record`` (header, block and end marks), and digest and length of the payload.

    A payload that many records share is joined once, to its response; revisits and records of small payloads
    join the narrow list of digests, by a shuffle that can split a digest's rows.
    """
    spark = headers.sparkSession
    right = F.sha2("payload", 256) == F.col("digest")
    wrong = F.raise_error(F.concat(F.lit("payload does not match its digest "), F.col("digest")))
    checked = payloads.select("digest", F.when(right, F.col("payload")).otherwise(wrong).alias("payload"))
    length = F.octet_length("payload").cast("long").alias("length")
    plain = spark.read.schema(payloads.schema).parquet(payload_path)
    small = F.when(F.octet_length("payload") < MIN_REVISIT, F.col("payload")).otherwise(F.lit(b""))
    listed = plain.select("digest", length, small.alias("block"))
    alone = (F.col("kind") == "response") & (F.col("stated") >= MIN_REVISIT)
    heads = headers.withColumn("kind", header_value("WARC-Type"))
    heads = heads.withColumn("stated", header_value("X-Payload-Length").cast("long"))
    whole = heads.filter(alone).join(checked.withColumn("block", F.col("payload")).withColumn("length", length), "digest")
    rest = heads.filter(~alone).join(listed, "digest")
    columns = ["header", "digest", "length", F.concat("header", "block", F.lit(b"\r\n\r\n")).alias("record")]
    return whole.select(*columns).unionByName(rest.select(*columns))


def header_value(name: str, column: str = "header") -> Column:
    """A header field read back from a record's bytes; null if it is not there."""
    head = F.split_part(F.decode(column, "UTF-8"), F.lit(CRLF * 2), F.lit(1))
    return F.nullif(F.regexp_extract(head, rf"(?m)^{name}: ([^\r]*)", 1), F.lit(""))


def parsed(records: DataFrame) -> DataFrame:
    """One row per record, read from its bytes; digest and length are those of the stored payload."""
    block = F.expr("substring(record, octet_length(header) + 1, octet_length(record) - octet_length(header) - 4)")
    kind, stated = header_value("WARC-Type"), header_value("WARC-Payload-Digest")
    right = (header_value("Content-Length").cast("long") == F.octet_length("block")) & (
        stated == F.concat(F.lit("sha256:"), F.when(kind == "revisit", F.col("digest")).otherwise(F.sha2("block", 256)))
    )
    return records.withColumn("block", block).select(
        header_value("X-Page-ID").cast("long").alias("page_id"),
        header_value("WARC-Target-URI").alias("url"),
        F.col("length").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.when(right, kind).otherwise(F.raise_error(F.lit("a record does not match its header"))).alias("record_type"),
        header_value("X-Refers-To-Page-ID").cast("long").alias("refers_to"),
    )
