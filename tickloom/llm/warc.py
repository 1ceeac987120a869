"""WARC as a content-addressed archive.

Payload bytes are stored once per distinct payload, under their SHA-256; record headers are stored apart,
byte for byte, with the digest of their payload. Reading joins the two and gives back every record: headers,
blank line, body, two line ends. Among records of equal payload the one of the largest page id holds it (a
response), the others name it (revisits).

On the way back each payload's length, SHA-256 and SHA-1 are computed anew and held against the store's key
and the record's header; a difference raises.

Edge cases: a null payload is an empty one; a null url has no WARC-Target-URI line, and controls and line or
paragraph separators in a url are percent-encoded, so no url makes a header line; a null page id has no WARC-Page-ID line and comes back as null (it counts as the smallest id);
rows that repeat id and payload are records of their own, of which one is the response; an empty table
makes an empty archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CRLF = "\r\n"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MIN_BYTES = 0


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: every 5 hex digits are 20 bits, or 4 base32 digits."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


# What may end a line for some reader: C0 and C1 controls and the two separators.
_SEPARATORS = [*map(chr, range(32)), *map(chr, range(127, 160)), "\u2028", "\u2029"]


def _plain_url(url: Column) -> Column:
    """The url with its controls and separators percent-encoded."""
    encoded = url
    for sign in _SEPARATORS:
        encoded = F.replace(encoded, F.lit(sign), F.lit("".join(f"%{b:02X}" for b in sign.encode())))
    return F.when(url.rlike("[\\x00-\\x1F\\x7F-\\x9F\\u2028\\u2029]"), encoded).otherwise(url)


def _record_id(row: Column) -> Column:
    h = F.md5(row.cast("string").cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def write_archive(
    pages: DataFrame, path: str, *, page: str = "page_id", url: str = "url", payload: str = "html",
    min_bytes: int = MIN_BYTES, date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write ``path``/headers and ``path``/payloads, a record per row of ``pages``.

    Only digests are compared and shuffled. Payload bytes go straight from the pages into the store; rows whose
    payload another row holds are left out by an anti-join on digests, whose small side Spark broadcasts or
    shuffles by its size on disk.
    """
    spark = pages.sparkSession
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(page).alias("page"), F.col(url).cast("string").alias("url"), body.alias("body"))
    rows = rows.withColumns({"sha256": F.sha2("body", 256), "bytes": F.octet_length("body").cast("long")})
    digests = rows.select("page", "url", "sha256", "bytes", base32_sha1(F.col("body")).alias("sha1"))
    # Row numbers are fixed by writing them, so that of rows alike in everything one can be told from another.
    digests.withColumn("row", F.monotonically_increasing_id()).write.parquet(f"{path}/digests")
    digests = spark.read.parquet(f"{path}/digests")

    holder = F.max(F.struct(F.col("page"), F.col("url"), F.col("row"))).alias("holder")
    groups = digests.where(F.col("bytes") >= min_bytes).groupBy("sha256").agg(holder, F.count(F.lit(1)).alias("n"))
    groups.where("n > 1").drop("n").write.parquet(f"{path}/groups")
    groups = spark.read.parquet(f"{path}/groups")

    marked = digests.join(groups, "sha256", "left").withColumn(
        "revisit", F.col("holder").isNotNull() & (F.col("holder.row") != F.col("row"))
    )
    lines = F.concat_ws(
        CRLF,
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), F.when(F.col("revisit"), "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("row"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), _plain_url(F.col("url"))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.when(F.col("revisit"), f"WARC-Profile: {REVISIT_PROFILE}"),
        F.when(F.col("revisit"), F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("holder.row")))),
        F.when(F.col("revisit"), F.concat(F.lit("WARC-Refers-To-Page-ID: "), F.col("holder.page").cast("string"))),
        F.concat(F.lit("WARC-Page-ID: "), F.col("page").cast("string")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(F.col("revisit"), F.lit(0)).otherwise(F.col("bytes")).cast("string")),
    )
    marked.select("row", "sha256", lines.alias("header")).write.parquet(f"{path}/headers")

    # A payload's copies under another page or url are told by (digest, page, url); copies alike in all three,
    # and records too small to be shared, are reduced to one by their digest alone.
    others = digests.join(groups, "sha256").where(F.col("holder.row") != F.col("row")).select("sha256", "page", "url", "holder")
    same = F.col("page").eqNullSafe(F.col("holder.page")) & F.col("url").eqNullSafe(F.col("holder.url"))
    others.select("sha256", "page", "url", same.alias("same")).distinct().write.parquet(f"{path}/others")
    others = spark.read.parquet(f"{path}/others")
    small = digests.where(F.col("bytes") < min_bytes).groupBy("sha256").count().where("count > 1").select("sha256")
    repeated = others.where("same").select("sha256").union(small).distinct()
    stored = rows.alias("r").join(
        others.where("not same").alias("o"),
        (F.col("r.sha256") == F.col("o.sha256")) & F.col("r.page").eqNullSafe(F.col("o.page")) & F.col("r.url").eqNullSafe(F.col("o.url")),
        "left_anti",
    ).select("sha256", "body")
    if repeated.isEmpty():
        stored.write.parquet(f"{path}/payloads")
    else:
        once = stored.join(repeated, "sha256", "left_anti")
        once.union(stored.join(repeated, "sha256", "left_semi").dropDuplicates(["sha256"])).write.parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """row, header, payload and the digests computed from it, per record; damaged payloads raise.

    Every record is joined with its payload by digest; a payload many records share is one key, which adaptive
    execution splits on the side of the headers.
    """
    headers, payloads = spark.read.parquet(f"{path}/headers"), spark.read.parquet(f"{path}/payloads")
    joined = headers.join(payloads, "sha256", "left")
    sha1 = base32_sha1(F.col("body"))
    told = F.regexp_extract("header", r"WARC-Payload-Digest: sha1:([A-Z2-7]{32})", 1)
    joined = joined.withColumn("payload_digest", sha1)
    wrong = F.col("body").isNull() | (F.sha2("body", 256) != F.col("sha256")) | (F.col("payload_digest") != told)
    checked = F.when(wrong, F.raise_error(F.concat(F.lit("damaged payload "), F.col("sha256")))).otherwise(F.col("payload_digest"))
    return joined.select(
        "row", "header", F.col("body").alias("payload"), F.octet_length("body").cast("long").alias("payload_bytes"),
        checked.cast("string").alias("payload_digest"),
    )


def header_field(name: str) -> Column:
    """A header's value, or null where the record has none."""
    found = F.regexp_extract("header", rf"(?md)^{name}: (.*?)\r?$", 1)
    return F.when(F.col("header").contains(f"\n{name}: "), found)


def records(spark: SparkSession, path: str) -> DataFrame:
    """The original records, byte for byte: row and record."""
    body = F.when(header_field("WARC-Type") == "response", F.col("payload")).otherwise(F.lit(b""))
    record = F.concat(F.col("header").cast("binary"), F.lit(b"\r\n\r\n"), body, F.lit(b"\r\n\r\n"))
    return read_archive(spark, path).where(F.col("payload_digest").isNotNull()).select("row", record.alias("record"))
