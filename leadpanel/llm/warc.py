"""WARC archives in which a payload is stored once and later captures revisit it.

Headers (page, digest) are shuffled by payload digest to find the capture that
keeps the payload; the pages are joined with that and written as records with
fresh headers through Spark's own writer, so a lost task is simply written
again. Each record is a gzip member of its own, as the format advises, followed
by a member with the blank lines that end it. Reading parses the archives and
joins each revisit to its response by record id.

Cases: a null payload is empty; payloads below ``min_bytes`` are always
responses; a null page id is written but never stands for others unless the
group has no other; rows that repeat both page id and payload are written once
each and are all responses if theirs is the largest id; an empty table gives an
empty archive.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Smaller payloads are stored each time: a revisit record would save nothing.
MIN_BYTES = 1000
#: Records in one archive file at most; keeps a file readable as a whole by one task.
RECORDS_PER_FILE = 20_000
#: Date in all headers, so that writing again gives the same bytes.
CAPTURED = "2024-01-01T00:00:00Z"

#: Ends a record; a gzip member of its own.
_END = gzip.compress(b"\r\n\r\n", mtime=0)
_READ_BYTES = 1 << 16


def record_id(page_id: int | None, digest: str) -> str:
    """Same page and payload, same id."""
    return f"urn:uuid:{uuid.UUID(hashlib.md5(f'{page_id}|{digest}'.encode()).hexdigest())}"


def resolve(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """The pages with ``payload_bytes, payload_digest`` and ``refers_to``, null for responses."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    headed = pages.select(
        "page_id", "url", "html",
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload).alias("payload_digest"),
    )
    shared = (
        headed.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("winner"), F.count(F.lit(1)).alias("captures"))
        .where("captures > 1")
        .select("payload_digest", "winner")
    )
    revisits = F.col("winner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("winner"))
    return headed.join(shared, "payload_digest", "left").select(
        "page_id", "url", "html", "payload_bytes", "payload_digest",
        F.when(revisits, F.col("winner")).alias("refers_to"),
    )


def _record(page_id, url, html, size, digest, refers_to) -> bytes:
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + (html or "").encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{record_id(page_id, digest)}>",
        f"WARC-Date: {CAPTURED}",
        f"WARC-Target-URI: {''.join((url or '').split())}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        lines.append(f"Page-ID: {page_id}")
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <{record_id(refers_to, digest)}>",
        ]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block, mtime=0)


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES) -> None:
    """Resolve revisits and write the archives into the folder ``path``."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                rows = batch.slice(low, 256).to_pydict()
                yield pa.RecordBatch.from_arrays([pa.array(list(map(_record, *rows.values())), pa.binary())], ["value"])

    # Bytes go through the text writer as they are; its line separator is the member that ends a record.
    (
        resolve(pages, min_bytes)
        .select("page_id", "url", "html", "payload_bytes", "payload_digest", "refers_to")
        .mapInArrow(records, "value binary")
        .select(F.col("value").cast("string"))
        .write.option("lineSep", _END.decode("latin-1")).option("encoding", "ISO-8859-1")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(path)
    )


def _members(data: memoryview) -> Iterator[bytes]:
    at = 0
    while at < len(data):
        stream, out = zlib.decompressobj(31), []
        while not stream.eof:
            part = data[at:at + _READ_BYTES]
            if not len(part):
                raise ValueError("archive ends inside a record")
            out.append(stream.decompress(part))
            at += len(part)
        at -= len(stream.unused_data)
        yield b"".join(out)


def parse_archive(data: memoryview) -> Iterator[dict]:
    """Each record of one archive: its headers, and the HTTP payload of a response."""
    for member in _members(data):
        if member == b"\r\n\r\n":
            continue
        head, _, block = member.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines)
        if not version.startswith("WARC/") or int(fields["Content-Length"]) != len(block):
            raise ValueError("not a WARC record")
        http, _, payload = block.partition(b"\r\n\r\n")
        fields["http"] = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
        if fields["WARC-Type"] == "response" and hashlib.sha1(payload).hexdigest() != fields["WARC-Payload-Digest"][5:]:
            raise ValueError("payload does not match its digest")
        fields["payload"] = payload
        yield fields


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per record: ids, payload size and digest, type, record id and the record it refers to."""
    schema = (
        "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
        "record string, refers string" + (", payload binary" if with_payload else "")
    )
    arrow = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("record", pa.string()), ("refers", pa.string()),
        *([("payload", pa.binary())] if with_payload else []),
    ])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for fields in parse_archive(memoryview(content.as_buffer())):
                    number = fields.get("Page-ID")
                    rows.append({
                        "page_id": None if number is None else int(number),
                        "url": fields["WARC-Target-URI"],
                        "payload_bytes": int(fields["http"]["Content-Length"]),
                        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                        "record_type": fields["WARC-Type"],
                        "record": fields["WARC-Record-ID"],
                        "refers": fields.get("WARC-Refers-To"),
                        **({"payload": fields["payload"]} if with_payload else {}),
                    })
                    if len(rows) >= 500:
                        yield pa.RecordBatch.from_pylist(rows, arrow)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, arrow)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(parse, schema)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Each record with ``refers_to``, the page id of the response a revisit names."""
    originals = records.where("record_type = 'response'").select(
        F.col("record").alias("refers"), F.col("page_id").alias("refers_to")
    ).distinct()
    return records.join(originals, "refers", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"
    )


ORACLE = """
WITH headed AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS winner, url
  FROM pages
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND winner <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND winner <> page_id THEN winner END AS refers_to,
       regexp_replace(coalesce(url, ''), '\\s+', '', 'g') AS url
FROM headed
"""
