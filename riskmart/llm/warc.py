"""Content-addressed WARC archive.

An archive is two Parquet tables in a shared folder.  ``payloads`` holds the bytes of each distinct payload once, under
its SHA-256; ``records`` holds the exact header text of every record (WARC header and, for responses, HTTP header), the
digest of its payload, and the ids of the page and of the one it refers to, which are never read out of the header.  Records are restored by joining the two; a payload whose bytes do not give its digest again
makes the read fail.

Of the records with equal payloads of at least ``min_bytes`` bytes that with the largest page_id is the response and the
others are revisits that refer to it; below ``min_bytes`` every record is a response.

Defined results: null html: an empty payload; null page_id: the smallest; among rows that repeat the largest page_id one
is the response; null url: an empty target URI; a url with control characters (line breaks among them) is percent-encoded
in the header, so that it cannot pose as another header line, and kept beside it as it was; texts of any length are stored
whole; an empty table gives an empty archive; other columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.llm.common import text_of
from riskmart.session import checkpoint_table, ensure_checkpoint_dir

CRLF = "\r\n"
#: The digits of Spark's base 32 and those of RFC 4648.
POSITIONAL, RFC4648 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base 32: each 5 of the 40 hex digits are 4 base-32 digits."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, at, 5), 16, 32), 4, "0") for at in range(1, 41, 5)]
    return F.translate(F.concat(*parts), POSITIONAL, RFC4648)


def urn(page_id: Column, nth: Column) -> Column:
    """Record id made from page_id and the number of the row among those that share it."""
    h = F.md5(F.concat_ws(":", F.lit("page"), F.coalesce(page_id.cast("string"), F.lit("null")), nth.cast("string")))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _lines(*pairs: tuple[str, Column]) -> Column:
    return F.concat(*[x for name, value in pairs for x in (F.lit(f"{name}: "), value, F.lit(CRLF))])


#: Characters that have no place in a header line.
CONTROLS = [chr(i) for i in (*range(32), 127)]


def header_uri(url: Column) -> Column:
    """``url`` with its control characters percent-encoded."""
    coded = url
    for c in CONTROLS:
        coded = F.replace(coded, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return F.when(F.translate(url, "".join(CONTROLS), "") == url, url).otherwise(coded)


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write ``pages`` (page_id, url, html) as an archive below ``path``."""
    html = text_of("html")
    pages = pages.select("page_id", F.coalesce(F.col("url"), F.lit("")).alias("url"),
                         F.encode(html, "UTF-8").alias("payload"))
    key = F.sha2("payload", 256).alias("sha256")
    pages.select(key, "payload").dropDuplicates(["sha256"]).write.parquet(f"{path}/payloads")
    slim = checkpoint_table(pages.select(
        "page_id", "url", key, F.octet_length("payload").cast("long").alias("bytes"),
        base32_sha1(F.col("payload")).alias("sha1"), F.monotonically_increasing_id().alias("rid")), "warc")
    first = slim.groupBy("sha256").agg(
        F.max(F.struct("page_id", "rid")).alias("top"), F.count(F.lit(1)).alias("n"))
    r = slim.join(first, "sha256").withColumn("uri", header_uri(F.col("url")))
    is_revisit = (F.col("bytes") >= min_bytes) & (F.col("rid") != F.col("top.rid"))
    own, other = urn(F.col("page_id"), F.col("rid")), urn(F.col("top.page_id"), F.col("top.rid"))
    length = F.col("bytes").cast("string")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    length, F.lit(CRLF * 2))
    shared = [("WARC-Record-ID", own), ("WARC-Date", F.lit(date)), ("WARC-Target-URI", F.col("uri")),
              ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
              ("X-Page-ID", F.coalesce(F.col("page_id").cast("string"), F.lit("")))]
    response = F.concat(F.lit(f"WARC/1.1{CRLF}WARC-Type: response{CRLF}"), _lines(
        *shared, ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", (F.col("bytes") + F.octet_length(http)).cast("string"))), F.lit(CRLF), http)
    revisit = F.concat(F.lit(f"WARC/1.1{CRLF}WARC-Type: revisit{CRLF}"), _lines(
        *shared, ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        ("WARC-Refers-To", other),
        ("X-Refers-To-Page-ID", F.coalesce(F.col("top.page_id").cast("string"), F.lit(""))),
        ("Content-Length", F.lit("0"))), F.lit(CRLF))
    r.select(F.when(is_revisit, revisit).otherwise(response).alias("header"), "sha256",
             F.col("page_id").cast("long").alias("page_id"),
             F.when(is_revisit, F.col("top.page_id").cast("long")).alias("refers_to"),
             F.when(F.col("url") != F.col("uri"), F.col("url")).alias("raw_url")).write.parquet(f"{path}/records")


def _verified(payloads: DataFrame) -> DataFrame:
    """The payloads; reading one whose bytes do not have its digest fails."""
    good = F.sha2("payload", 256) == F.col("sha256")
    return payloads.withColumn("payload", F.when(good, F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload does not have the digest "), F.col("sha256")))))


def _header(name: str) -> Column:
    return F.regexp_extract("header", rf"\r\n{name}: ([^\r\n]*)\r\n", 1)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The index of an archive from its headers and verified payloads: page_id, url, record_id, record_type, refers_to,
    payload_bytes, payload_digest."""
    records = spark.read.parquet(f"{path}/records")
    blobs = _verified(spark.read.parquet(f"{path}/payloads")).select(
        "sha256", F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"))
    r = records.join(blobs, "sha256", "left")
    same = F.concat(F.lit("sha1:"), F.col("payload_digest")) == _header("WARC-Payload-Digest")
    checked = F.when(same, F.col("payload_digest")).otherwise(
        F.raise_error(F.lit("a record's payload is missing or not the one in its header")))
    return r.select(
        "page_id", F.coalesce(F.col("raw_url"), _header("WARC-Target-URI")).alias("url"),
        _header("WARC-Record-ID").alias("record_id"), _header("WARC-Type").alias("record_type"), "refers_to", "payload_bytes",
        checked.alias("payload_digest"))


def restore(spark: SparkSession, path: str) -> DataFrame:
    """Every record with its full payload: page_id, record_type, header, payload (also for revisits)."""
    records = spark.read.parquet(f"{path}/records")
    blobs = _verified(spark.read.parquet(f"{path}/payloads"))
    return records.join(blobs, "sha256").select(
        "page_id", _header("WARC-Type").alias("record_type"), "header", "payload")


def export_warc(spark: SparkSession, path: str, out: str) -> None:
    """Write the archive as plain WARC files: each record's header, its block, and two line ends."""
    r = restore(spark, path)
    block = F.when(F.col("record_type") == "response", F.decode("payload", "UTF-8")).otherwise(F.lit(""))
    r.select(F.concat("header", block, F.lit(CRLF))).write.option("lineSep", CRLF).text(out)


def archive(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to an archive in the shared checkpoint folder and read its index back."""
    spark = pages.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archive(pages, path, min_bytes)
    return read_records(spark, path)
