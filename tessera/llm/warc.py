"""Content-addressed WARC archive.

Two tables: payloads holds the bytes of each distinct payload once, under its SHA-256; headers holds the exact header bytes
of each record and the digest it points to. A record is rebuilt by joining the two, and its payload is checked against its
digests on the way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import new_path, skew_join, stored

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # fixed values: RFC 4648
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value: WARC 1.1
CRLF = "\r\n"
# Line feed, vertical tab, form feed, carriage return, next line, line and paragraph separator, each as its percent-encoded UTF-8.
LINE_ENDS = (("\n", "%0A"), ("\x0b", "%0B"), ("\x0c", "%0C"), ("\r", "%0D"), ("\x85", "%C2%85"), ("\u2028", "%E2%80%A8"), ("\u2029", "%E2%80%A9"))


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of SHA-1: 20 bits, which are 5 hexadecimal or 4 base32 digits, at a time."""
    digits = F.sha1(data)
    out = []
    for i in range(8):
        bits = F.conv(F.substring(digits, 5 * i + 1, 5), 16, 10).cast("int")
        out += [F.substr(F.lit(BASE32), F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
    return F.concat(*out)


def record_id(page: Column, row: Column) -> Column:
    digest = F.md5(F.concat_ws(":", F.lit("page"), F.coalesce(page.cast("string"), F.lit("null")), row.cast("string")))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(digest, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def one_line(url: Column) -> Column:
    """url with each character that ends a line somewhere percent-encoded."""
    for sign, code in LINE_ENDS:
        url = F.replace(url, F.lit(sign), F.lit(code))
    return url


def write_archive(pages: DataFrame, path: str, date: str = "2020-01-01T00:00:00Z") -> None:
    """Writes path/payloads and path/headers.

    The payload is html in UTF-8, empty where html is null. Of records with equal payloads the one with the smallest page_id
    is the response, all others are revisits of it; of several rows with that page_id one is the response, which one being
    open, and a null page_id counts as larger than any. Record ids are unique, also among equal rows. A null url leaves its
    line out; characters that end a line are percent-encoded in urls. An empty table makes an empty archive.
    """
    body = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")).withColumn("sha256", F.sha2("payload", 256))
    # Copies meet in the map side's partial aggregation, so that few of their bytes are shuffled.
    body.groupBy("sha256").agg(F.count("*").alias("copies"), F.first("payload").alias("payload")).write.option("compression", "zstd").parquet(f"{path}/payloads")
    narrow = stored(body.select("page_id", "url", "sha256", F.octet_length("payload").alias("length"), base32_sha1(F.col("payload")).alias("sha1"), F.monotonically_increasing_id().alias("row")), "records")
    least = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row"))
    first = stored(narrow.groupBy("sha256").agg(least.alias("first"), F.count("*").alias("copies")), "first")
    kept = skew_join(narrow, first, "sha256", "copies").withColumn("is_response", F.col("row") == F.col("first.row"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("length").cast("string"), F.lit(CRLF * 2))
    block = F.octet_length(http) + F.when(F.col("is_response"), F.col("length")).otherwise(0)
    refers = F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", record_id(F.col("first.page_id"), F.col("first.row"))), F.coalesce(line("X-Refers-To-Page", F.col("first.page_id").cast("string")), F.lit("")))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"), line("WARC-Type", F.when(F.col("is_response"), F.lit("response")).otherwise(F.lit("revisit"))),
        line("WARC-Record-ID", record_id(F.col("page_id"), F.col("row"))), line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", one_line(F.col("url"))), F.lit("")), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.coalesce(line("X-Page-Id", F.col("page_id").cast("string")), F.lit("")), F.when(F.col("is_response"), F.lit("")).otherwise(refers),
        line("Content-Type", F.lit("application/http; msgtype=response")), line("Content-Length", block.cast("string")), F.lit(CRLF), http,
    )
    kept.select("sha256", header.cast("binary").alias("header")).write.option("compression", "zstd").parquet(f"{path}/headers")


def must(condition: Column, value: Column, kind: str, otherwise: str) -> Column:
    return F.when(condition, value).otherwise(F.raise_error(F.lit(otherwise)).cast(kind))


def field(name: str, head: str = "head") -> Column:
    """The value of a header's first line of that name, null if it has none. Lines end with a line feed, whatever else Java takes for an end."""
    found = F.regexp_extract(F.col(head), rf"(?md)^{name}: ([^\r\n]*)", 1)
    return F.when(found != "", found)


def parsed_headers(spark: SparkSession, path: str) -> DataFrame:
    """One row per record from its header bytes: sha256, header, page_id, record_type, payload_digest, payload_bytes, refers_to."""
    held = spark.read.parquet(f"{path}/headers").withColumn("head", F.col("header").cast("string"))
    warc, http = F.substring_index("head", CRLF * 2, 1), F.element_at(F.split("head", CRLF * 2), 2)
    held = held.withColumns({"head": F.concat(warc, F.lit(CRLF)), "http": F.concat(http, F.lit(CRLF))})
    return held.select("sha256", "header", field("X-Page-Id").cast("long").alias("page_id"), field("WARC-Type").alias("record_type"), F.replace(field("WARC-Payload-Digest"), F.lit("sha1:"), F.lit("")).alias("payload_digest"), field("Content-Length", "http").cast("long").alias("payload_bytes"), field("X-Refers-To-Page").cast("long").alias("refers_to"))


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """sha256, payload, copies: each payload once; fails if stored bytes don't have the digest that they are stored under."""
    held = spark.read.parquet(f"{path}/payloads").select("sha256", "payload", "copies")
    return held.withColumn("payload", must(F.sha2("payload", 256) == F.col("sha256"), F.col("payload"), "binary", "a stored payload does not have its digest"))


def responses(spark: SparkSession, path: str) -> DataFrame:
    """The response records as they were, header and payload bytes joined again: sha256, page_id, copies, record, and what is parsed from that record."""
    heads = parsed_headers(spark, path).where("record_type = 'response'")
    whole = heads.join(payloads(spark, path), "sha256").withColumn("record", F.concat("header", "payload", F.lit(CRLF * 2).cast("binary")))
    start = F.octet_length(F.substring_index(F.col("record").cast("string"), CRLF * 2, 2)) + 4
    body = F.substring(F.col("record"), start + 1, F.octet_length("record") - start - 4)
    whole = whole.withColumn("_body", body).withColumn("_ok", (F.octet_length("_body") == F.col("payload_bytes")) & (base32_sha1(F.col("_body")) == F.col("payload_digest")))
    return whole.select("sha256", "page_id", "copies", "record", must(F.col("_ok"), F.octet_length("_body").cast("long"), "long", "a record's payload does not agree with its header").alias("payload_bytes"), "payload_digest")


def revisits(spark: SparkSession, path: str) -> DataFrame:
    """The revisit records with the payload that they refer to: page_id, refers_to, header, payload. Spark splits the rows of a payload with very many copies."""
    return parsed_headers(spark, path).where("record_type = 'revisit'").join(payloads(spark, path), "sha256").select("page_id", "refers_to", "header", "payload")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each record.

    Each response is rebuilt and verified, and each revisit compared with the response that its digest leads to.
    """
    found = stored(responses(spark, path).groupBy("sha256").agg(F.max("copies").alias("copies"), F.max("payload_bytes").alias("_bytes"), F.max("payload_digest").alias("_digest")), "verified")
    all_ = skew_join(parsed_headers(spark, path).drop("header"), found, "sha256", "copies")
    agree = (F.col("payload_bytes") == F.col("_bytes")) & (F.col("payload_digest") == F.col("_digest"))
    return all_.select("page_id", must(agree, F.col("_bytes"), "long", "a record does not agree with the payload it refers to").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return read_archive(spark, path)


SQL_OP5 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, h, strlen(h) AS payload_bytes, sha1(h) AS s, min(page_id) OVER w AS first_id, row_number() OVER (w ORDER BY page_id) AS n FROM p WINDOW w AS (PARTITION BY h))
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  list_reduce(list_transform(range(0, 8), lambda i: list_reduce(list_transform([15, 10, 5, 0], lambda k:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(s, 5 * i + 1, 5))::BIGINT >> k) & 31)::INT + 1, 1)), lambda a, b: a || b)), lambda a, b: a || b) AS payload_digest,
  CASE WHEN n = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN n > 1 THEN first_id END AS refers_to FROM d
"""

QUERIES, SQL = {"op5_warc": op5_warc}, {"op5_warc": SQL_OP5}
