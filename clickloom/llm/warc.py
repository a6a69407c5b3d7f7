"""A content-addressed WARC archive: payload bytes once by strong digest, exact record headers apart, records by join.

An archive is a folder with two tables. ``payloads`` holds each distinct payload once under its SHA-256 digest. ``records``
holds, for each page, the exact bytes of its WARC header and the digest of its payload. Of the records with one payload of at
least ``least`` bytes, that with the largest page id is a response and the others are revisits that refer to it. Reading
verifies every payload against its address, joins records to payloads and parses the headers; header, payload and two line
breaks are the original record.

Payloads of one digest are combined before the shuffle, so a payload that a third of all pages share is sent once by
each task; records carry no payload.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEAST_BYTES = 1000
BREAK = "\r\n"


def _one_line(value: Column) -> Column:
    """Control characters would end a header field; they are written as in a URL."""
    value = F.regexp_replace(value, "\r", "%0D")
    value = F.regexp_replace(value, "\n", "%0A")
    return F.regexp_replace(value, "\\x00", "%00")


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def _header() -> Column:
    revisit = F.col("record_type") == "revisit"
    field = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(BREAK))
    none = F.lit("")
    return F.concat(
        F.lit(f"WARC/1.1{BREAK}"),
        field("WARC-Type", F.col("record_type")),
        field("WARC-Record-ID", _urn(F.col("page_id"))),
        field("WARC-Date", F.date_format(F.to_utc_timestamp("captured", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.coalesce(field("WARC-Target-URI", _one_line(F.col("url"))), none),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, field(
            "WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(none),
        F.when(revisit, field("WARC-Refers-To", _urn(F.col("holder")))).otherwise(none),
        field("Content-Type", F.lit("text/html; charset=utf-8")),
        field("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("size").cast("string"))),
        F.lit(BREAK),
    )


def write_archive(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_BYTES,
    captured: str | None = None,
) -> None:
    """Write an archive of ``pages`` to a new folder.

    ``captured`` names a timestamp column for the dates of the records; without it, or where it is null, they have the time of
    writing.
    A null html is an empty payload, a null url leaves its header field out, a null page id is written as ``none`` and is
    never the largest. Repeated rows give repeated records; rows that share the largest id of a payload are all responses.
    An empty table gives an empty archive. Other columns are not stored.
    """
    payload = F.encode(F.coalesce(F.col(html).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload"),
        F.coalesce(*([F.col(captured).cast("timestamp")] if captured else []), F.current_timestamp()).alias("captured"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("payload", 256)))
    rows.groupBy("digest").agg(F.first("payload").alias("payload")).write.option("compression", "zstd").parquet(
        f"{path}/payloads")
    figures = rows.select(
        "page_id", "url", "captured", "digest", F.octet_length("payload").cast("long").alias("size"), F.sha1("payload").alias("sha1"))
    holders = figures.where(F.col("size") >= least).groupBy("digest").agg(F.max("page_id").alias("holder"))
    records = figures.join(holders, "digest", "left")
    later = F.col("holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("holder"))
    records = records.withColumn("record_type", F.when(later, F.lit("revisit")).otherwise(F.lit("response")))
    records.select("digest", _header().alias("header")).write.option("compression", "zstd").parquet(f"{path}/records")


def read_archive(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record: what its header says, and the size, digests and (if wanted) bytes of its payload.

    ``payload_bytes`` and ``payload_digest`` are taken from the stored bytes, not from the header. A payload that does not
    have the digest it is stored under, or whose SHA-1 is not that of the header, is an error.
    """
    stored = spark.read.schema("digest binary, payload binary").parquet(f"{path}/payloads")
    sound = F.unhex(F.sha2("payload", 256)) == F.col("digest")
    checked = stored.select(
        "digest",
        F.when(sound, F.col("payload")).otherwise(F.raise_error(F.lit("a payload differs from its digest")))
        .alias("payload"),
    ).select(
        "digest", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"),
        *(["payload"] if with_payload else []),
    )
    records = spark.read.schema("digest binary, header string").parquet(f"{path}/records")
    field = lambda name: F.regexp_extract("header", f"\r\n{name}: ([^\r\n]*)\r\n", 1)
    number = lambda name: F.expr("try_cast(regexp_extract(" + name + ", '^<urn:page:(-?[0-9]+)>$', 1) as long)")
    parsed = records.join(checked, "digest").select(
        "*", field("WARC-Type").alias("record_type"), field("WARC-Date").alias("date"), field("WARC-Record-ID").alias("_id"),
        field("WARC-Refers-To").alias("_refers"), field("WARC-Payload-Digest").alias("_sha1"),
        F.when(field("WARC-Target-URI") != "", field("WARC-Target-URI")).alias("target_uri"))
    same = F.concat(F.lit("sha1:"), F.col("payload_digest")) == F.col("_sha1")
    return parsed.select(
        number("_id").alias("page_id"), "target_uri", "payload_bytes",
        F.when(same, F.col("payload_digest")).otherwise(F.raise_error(F.lit("a record and its payload differ")))
        .alias("payload_digest"),
        "record_type", number("_refers").alias("refers_to"), "date", "header", *(["payload"] if with_payload else []),
    )


def record_bytes(records: DataFrame) -> DataFrame:
    """(page_id, record): each record as it stands in a WARC file; revisits have no payload."""
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return records.select(
        "page_id",
        F.concat(F.encode("header", "UTF-8"), body, F.encode(F.lit(BREAK + BREAK), "UTF-8")).alias("record"))
