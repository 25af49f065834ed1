"""WARC archives with each payload kept once.

Payload headers are shuffled by payload digest, each group's original is found,
copies become ``revisit`` records that refer to it, and the archives are written
with fresh headers by Spark's text writer: any file system Spark can write to
will do, and a lost task is simply written again. Files are gzip-compressed as a
whole, one per task.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources.scratch import written

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEX32, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(text: Column) -> Column:
    """The SHA-1 of a text's UTF-8 bytes in upper-case base32."""
    digits = F.sha1(F.encode(text, "UTF-8"))
    # 5 hex digits are 20 bits are 4 base32 digits.
    parts = [F.lpad(F.conv(F.substring(digits, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), HEX32, BASE32)


def with_originals(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``records`` (page_id, url, payload) with payload_digest, payload_bytes and
    the original's ``original_id`` and ``original_url`` (null if there is none
    other than the record itself).

    Records of equal payloads of at least ``min_bytes`` bytes share the original
    with the largest page_id. Only (digest, page_id) is shuffled to find it, one
    row per digest and task; payloads that occur once are never looked up. A
    payload that a third of all rows share is split over tasks in the join, as
    the table of originals is written first and both sides are plain scans.
    Records that repeat the original's page_id are originals too; a null page_id
    is smaller than any other, and records that all lack one are all originals.
    """
    digested = records.select(
        "page_id",
        "url",
        "payload",
        base32_sha1(F.col("payload")).alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
    )
    headers = digested.select("page_id", "url", "payload_digest", "payload_bytes")
    repeated = (
        headers.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("original_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND original_id IS NOT NULL")
        .select("payload_digest", "original_id")
    )
    repeated = written(repeated, "warc-repeated")
    # The original's address: one page per repeated digest, ties by address.
    urls = (
        headers.join(
            repeated.withColumnRenamed("payload_digest", "_digest"),
            (F.col("payload_digest") == F.col("_digest"))
            & (F.col("page_id") == F.col("original_id")),
        )
        .groupBy("payload_digest", "original_id")
        .agg(F.max(F.coalesce("url", F.lit(""))).alias("original_url"))
    )
    originals = written(urls, "warc-originals")
    joined = digested.join(
        originals.withColumnRenamed("payload_digest", "_digest"),
        (F.col("payload_digest") == F.col("_digest")) & (F.col("payload_bytes") >= min_bytes),
        "left",
    )
    other = F.col("original_id").isNotNull() & ~F.col("original_id").eqNullSafe(F.col("page_id"))
    return joined.select(
        *digested.columns,
        F.when(other, F.col("original_id")).alias("original_id"),
        F.when(other, F.col("original_url")).alias("original_url"),
    )


def _line(name: str, value: Column) -> Column:
    # A header value is one line whatever the page says.
    value = F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), "[\r\n]+", " ")
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def write_archives(
    pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z"
) -> None:
    """Write a record per page (page_id long, url, html; others are ignored).

    The payload is the html in UTF-8; null html is an empty payload. ``date`` is
    the date of every record. A page id missing is written as an empty one.
    """
    records = with_originals(
        pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload")), min_bytes
    )
    revisit = F.col("original_id").isNotNull()
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    head = F.concat(
        F.lit("WARC/1.1" + CRLF),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _record_id(F.col("page_id"))),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _line("X-Payload-Length", F.col("payload_bytes")),
        F.when(
            revisit,
            F.concat(
                _line("WARC-Profile", F.lit(PROFILE)),
                _line("WARC-Refers-To", _record_id(F.col("original_id"))),
                _line("WARC-Refers-To-Target-URI", F.col("original_url")),
                _line("WARC-Refers-To-Date", F.lit(date)),
            ),
        ).otherwise(F.lit("")),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.octet_length(body)),
    )
    (
        records.select(F.concat(head, F.lit(CRLF), body).alias("value"))
        .write.option("compression", "gzip")
        .option("lineSep", CRLF + CRLF)
        .text(path)
    )


RECORD_SCHEMA = (
    "page_id long, url string, record_type string, payload_digest string, "
    "payload_bytes long, refers_to long, payload string"
)


def _page_id(value: str) -> int | None:
    number = value.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _records(lines: Iterator[str]) -> Iterator[dict]:
    """Records of archives given line by line; one task reads whole files."""
    for line in lines:
        if not line.startswith("WARC/"):
            if line:
                raise ValueError(f"no record begins with {line[:80]!r}")
            continue
        head = {}
        for line in lines:
            if not line:
                break
            name, _, value = line.partition(": ")
            head[name.lower()] = value
        length = int(head["content-length"])
        block: list[str] = []
        have = -len(CRLF)
        while have < length:
            line = next(lines)
            block.append(line)
            have += len(line.encode()) + len(CRLF)
        text = CRLF.join(block)
        if len(text.encode()) != length:
            raise ValueError(f"a block of {length} bytes is cut at {len(text.encode())}")
        yield head | {"block": text}


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of archives under ``path``, without their payloads' copies.

    A response's digest and length are computed from the payload read and must
    agree with its header; a revisit's payload is null. Files are read line by
    line, so a task holds one record at a time.
    """
    # The schema of what is written; nothing is read to find it out.
    lines = spark.read.option("lineSep", CRLF).schema("value string").text(path)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def all_lines() -> Iterator[str]:
            for batch in batches:
                yield from batch.column(0).to_pylist()

        names = ["page_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to"]
        types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        schema = pa.schema([*zip(names, types, strict=True), ("payload", pa.string())])
        rows: list[tuple] = []
        held = 0
        for r in _records(all_lines()):
            revisit = r["warc-type"] == "revisit"
            digest = r["warc-payload-digest"].removeprefix("sha1:")
            length = int(r["x-payload-length"])
            if not revisit:
                data = r["block"].encode()
                found = base64.b32encode(hashlib.sha1(data).digest()).decode()
                if (found, len(data)) != (digest, length):
                    raise ValueError(f"{r['warc-record-id']}: payload does not match its header")
            rows.append(
                (
                    _page_id(r["warc-record-id"]),
                    r["warc-target-uri"],
                    r["warc-type"],
                    digest,
                    length,
                    _page_id(r["warc-refers-to"]) if revisit else None,
                    None if revisit else r["block"],
                )
            )
            held += len(r["block"])
            if len(rows) >= 2_000 or held > 1 << 23:
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(schema.names, x, strict=True)) for x in rows], schema
                )
                rows, held = [], 0
        yield pa.RecordBatch.from_pylist(
            [dict(zip(schema.names, x, strict=True)) for x in rows], schema
        )

    return lines.mapInArrow(parse, RECORD_SCHEMA)
