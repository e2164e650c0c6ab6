"""WARC archives of pages in which equal payloads are stored once.

The headers' payload digests meet in a shuffle; each digest's newest record becomes the response and the others revisit
it. Records are text up to their payload, so Spark's text writer writes the archives, with the blank line that ends a
record as its separator.
"""

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chirrup.llm.common import stored

RECORD_END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_RECORDS = (
    "record_id string, record_type string, target_uri string, payload_digest string, payload_bytes long, "
    "refers_to string, payload binary"
)


def base32_sha1(payload: Column) -> Column:
    """The digest as archives write it: 32 upper-case letters and digits, no prefix."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _one_line(value: Column) -> Column:
    """A value that cannot end its header line."""
    return F.regexp_replace(value, r"[\x00-\x20\x7F]", "_")


def resolved(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0) -> DataFrame:
    """`page_id, url, payload, payload_bytes, payload_digest, record_id, record_type, refers_to` for each page.

    Of the records with one payload of at least `least_bytes` bytes, that with the largest key is a `response`; the others
    are `revisit`s, refer to its record id and lose their payload here. Rows that share the largest key are told apart by
    their stored place, a null key is smaller than any, and a null payload is empty. Each row gives one record.
    """
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", base32_sha1(F.encode("payload", "utf-8")))
    rows = stored(rows.withColumn("place", F.monotonically_increasing_id()))
    newest = (
        rows.filter(F.col("payload_bytes") >= least_bytes)
        .groupBy(F.col("payload_digest").alias("_digest"))
        .agg(F.max(F.struct(F.coalesce("page_id", F.lit(-(2**63))).alias("order"), "place", "page_id")).alias("_newest"), F.count("*").alias("_copies"))
        .filter("_copies > 1")
    )
    joined = rows.join(newest, F.col("payload_digest") == F.col("_digest"), "left")
    revisit = (F.col("place") != F.col("_newest.place")) & (F.col("payload_bytes") >= least_bytes)
    named = lambda page, place: F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(":"), place, F.lit(">"))
    return joined.select(
        "page_id",
        "url",
        F.when(F.coalesce(revisit, F.lit(False)), F.lit(None)).otherwise(F.col("payload")).alias("payload"),
        "payload_bytes",
        "payload_digest",
        named(F.col("page_id"), F.col("place")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, named(F.col("_newest.page_id"), F.col("_newest.place"))).alias("refers_to"),
    )


def write_archives(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write what `resolved` returns as WARC 1.1 files below `path`, one for each task, with fresh headers."""
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes"), F.lit(RECORD_END)
    )
    block = F.concat(http, F.coalesce("payload", F.lit("")))
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"\r\n{name}: "), value), F.lit(""))
    revisit = F.col("record_type") == "revisit"
    record = F.concat(
        F.lit("WARC/1.1"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Target-URI", _one_line(F.col("url"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("WARC-Refers-To", F.col("refers_to")),
        line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length(block)),
        F.lit(RECORD_END),
        block,
    )
    records.select(record.alias("value")).write.option("lineSep", RECORD_END).option("compression", compression).text(path)


def _headers(stream: io.BufferedIOBase) -> dict[str, str] | None:
    """The header lines up to the blank one; None at the end of the file."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    found = {"": line.decode().strip()}
    while line and (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        name, _, value = line.decode().partition(":")
        found[name.strip().lower()] = value.strip()
    return found if found[""] else None


def _parsed(content: bytes) -> Iterator[tuple]:
    raw = io.BytesIO(content)
    stream = io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 20) if content[:2] == b"\x1f\x8b" else raw
    while (headers := _headers(stream)) is not None:
        if not headers[""].startswith("WARC/"):
            raise ValueError("no WARC record where one should begin")
        block = stream.read(whole := int(headers["content-length"]))
        if len(block) < whole:
            raise ValueError(f"a WARC record of {whole} bytes ends after {len(block)}")
        payload, size = block, len(block)
        if headers.get("content-type", "").startswith("application/http"):
            http = _headers(body := io.BytesIO(block))
            payload, size = body.read(), int(http.get("content-length", -1))
        kind = headers.get("warc-type")
        digest = headers.get("warc-payload-digest")
        digest = digest and digest.removeprefix("sha1:")
        if kind == "response":
            if len(payload) < size:
                raise ValueError(f"a payload of {size} bytes ends after {len(payload)}")
            said, size = headers.get("warc-payload-digest", ""), len(payload)
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if said.startswith("sha1:") and said != f"sha1:{digest}":
                raise ValueError(f"a payload has digest sha1:{digest}, its header says {said}")
        yield (
            headers.get("warc-record-id"), kind, headers.get("warc-target-uri"), digest,
            len(payload) if size < 0 else size, headers.get("warc-refers-to"), None if kind == "revisit" else payload,
        )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of WARC files, plain or gzip: `record_id, record_type, target_uri, payload_digest, payload_bytes, refers_to, payload`.

    A file is read by one task, which holds its compressed bytes and one record at a time; records are found by their
    lengths, so a payload may hold anything. Size and digest of a response are those of the payload as read; a record or
    payload that ends early, or whose SHA-1 is not that of its header, stops the job. The payload of a revisit is null; its size is that of the whole payload.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("payload_digest", pa.string()),
                            ("payload_bytes", pa.int64()), ("refers_to", pa.string()), ("payload", pa.binary())])
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for row in _parsed(content.as_py()):
                    rows.append(row)
                    size += len(row[-1] or b"")
                    if size > 1 << 22 or len(rows) >= 5000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parse, _RECORDS)
