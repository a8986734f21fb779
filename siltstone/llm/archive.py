"""A content-addressed web archive: payloads once by digest, exact record headers apart.

``write_archive`` keeps two tables below a folder: ``payloads`` (SHA-256, bytes,
one row per distinct payload) and ``headers`` (one exact WARC header block per
record, with the digest it belongs to).  ``read_archive`` joins them back into
whole records and verifies every payload against its address and its header.

Defined results: null html is an empty payload; of equal payloads the record
with the largest page_id is the response and the others are revisits of it; rows
repeated with that page_id are responses too; a null page_id counts as the
smallest; a null url is written as an empty target.  Empty tables give empty
archives, other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the record format and of base 32.
VERSION = "WARC/1.1"
BREAK = "\r\n"
BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RADIX32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:page:"
CONTENT_TYPE = "text/html; charset=utf-8"
DATE = "1970-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base 32 of the SHA-1: 160 bits are four groups of 40, eight digits each."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*groups), RADIX32_DIGITS, BASE32_DIGITS)


def _header(record_type: Column, refers_to: Column, date: str) -> Column:
    """The header block of a record, up to and including its empty line."""
    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(BREAK))

    return F.concat(
        F.lit(VERSION + BREAK),
        line("WARC-Type", record_type),
        line("WARC-Record-ID", F.concat(F.lit(f"<{RECORD_ID}"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), "[\r\n]", " ")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(
            refers_to.isNotNull(),
            F.concat(
                line("WARC-Refers-To", F.concat(F.lit(f"<{RECORD_ID}"), refers_to.cast("string"), F.lit(">"))),
                line("WARC-Profile", F.lit(REVISIT_PROFILE)),
                line("Content-Length", F.lit("0")),
            ),
        ).otherwise(
            F.concat(line("Content-Type", F.lit(CONTENT_TYPE)), line("Content-Length", F.col("payload_bytes").cast("string")))
        ),
        F.lit(BREAK),
    )


def write_archive(pages: DataFrame, path: str, date: str = DATE) -> None:
    """Write the ``payloads`` and ``headers`` tables of ``pages`` (``page_id``, ``url``, ``html``) below ``path``.

    ``date`` is when the pages were fetched, which the table does not tell.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    records = pages.select(
        "page_id",
        "url",
        F.sha2(payload, 256).alias("address"),
        base32_sha1(payload).alias("payload_digest"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
    )
    # One row per address and task before the shuffle, whatever a payload's number of copies.
    owners = records.groupBy("address").agg(F.max("page_id").alias("owner"))
    revisit = F.col("page_id").isNull() & F.col("owner").isNotNull() | (F.col("page_id") < F.col("owner"))
    headed = records.join(owners, "address").select(
        "address",
        _header(
            F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), F.when(revisit, F.col("owner")), date
        ).alias("header"),
    )
    headed.write.parquet(f"{path}/headers")
    blobs = pages.select(F.sha2(payload, 256).alias("address"), payload.alias("payload"))
    blobs.groupBy("address").agg(F.first("payload").alias("payload")).write.parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Whole records: ``address``, ``header``, ``payload`` (the full one, for revisits too).

    A payload whose bytes do not hash to its address, or a header whose digest
    is not that of its payload, fails the read.
    """
    payloads = spark.read.parquet(f"{path}/payloads")
    sound = F.sha2("payload", 256) == F.col("address")
    payloads = payloads.select(
        "address",
        F.when(sound, F.col("payload")).otherwise(F.raise_error(F.lit("a payload does not match its address"))).alias("payload"),
    ).select("address", "payload", base32_sha1(F.col("payload")).alias("found_digest"), F.octet_length("payload").cast("long").alias("payload_bytes"))
    headers = spark.read.parquet(f"{path}/headers")
    joined = headers.join(payloads, "address")
    agrees = _field("WARC-Payload-Digest", "sha1:(\\S+)") == F.col("found_digest")
    return joined.withColumn(
        "found_digest",
        F.when(agrees, F.col("found_digest")).otherwise(F.raise_error(F.lit("a record does not match its payload"))),
    )


def _field(name: str, pattern: str) -> Column:
    return F.regexp_extract("header", f"(?:^|\r\n){name}: {pattern}\r\n", 1)


def parsed(records: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to`` out of read records."""
    def number(text: Column) -> Column:
        return F.when(text != "", text).cast("long")

    return records.select(
        number(_field("WARC-Record-ID", f"<{RECORD_ID}(-?\\d*)>")).alias("page_id"),
        "payload_bytes",
        F.col("found_digest").alias("payload_digest"),
        _field("WARC-Type", "(\\w+)").alias("record_type"),
        number(_field("WARC-Refers-To", f"<{RECORD_ID}(-?\\d+)>")).alias("refers_to"),
        _field("WARC-Target-URI", "([^\r\n]*)").alias("url"),
    )


def record_bytes(records: DataFrame) -> DataFrame:
    """The exact bytes of every record as an archive file holds them; a revisit has no block."""
    block = F.when(_field("WARC-Type", "(\\w+)") == "response", F.col("payload")).otherwise(F.lit(b""))
    return records.withColumn("record", F.concat(F.col("header").cast("binary"), block, F.lit(b"\r\n\r\n")))


def reread(records: DataFrame) -> DataFrame:
    """Records as ``record_bytes`` gives them, with the header taken out of the bytes again.

    A record whose block is not as long as its header says, or that does not end
    as a record must, fails the read.
    """
    head = F.concat(F.substring_index(F.col("record").cast("string"), BREAK + BREAK, 1), F.lit(BREAK + BREAK))
    parts = records.withColumn("header", head).withColumn("_size", F.octet_length("header"))
    length = _field("Content-Length", "(\\d+)").cast("int")
    whole = (F.octet_length("record") == F.col("_size") + length + 4) & (F.substring("record", -4, 4) == F.lit(b"\r\n\r\n"))
    failed = F.raise_error(F.lit("a record is not as long as its header says"))
    return parts.withColumn("header", F.when(whole, F.col("header")).otherwise(failed)).drop("_size")
