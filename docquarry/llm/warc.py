"""WARC archives: one record per page, segments, chunked framing, and reading them back.

Writing. Every row of ``pages`` becomes one record. Of rows with equal payloads the one with the
smallest id is a ``response``; the others are ``revisit`` records that name it. A response's block is an
HTTP message in chunked transfer framing. A block over ``segment_bytes`` is cut into a first record and
``continuation`` records that name it by ``WARC-Segment-Origin-ID``; the last one states the total length.

The archives are written with Spark's text writer and read with its text reader, with the record's
first line as the line separator. So they can lie in any store Spark reaches, large uncompressed
archives are split among tasks, and no task holds more than a record. The framing never lets that line
occur inside a block: a chunk ends inside each occurrence of its text.

Reading. Continuations are grouped by the id of their origin, ordered by segment number, joined, and
checked against the total length; then the chunked framing is decoded.

Defined results: a null payload is empty. Rows with the smallest id of their payload are responses even
where they repeat; rows without an id are revisits, or responses if no row of that payload has an id.
Very long payloads are segmented. Other input columns are ignored. An empty table gives no records. A
block that is cut short, a missing segment or a wrong digest is reported in ``problem``, not dropped.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.llm.common import column, steps, store

VERSION = b"WARC/1.1"
SEPARATOR = "WARC/1.1\r\n"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
CHUNKED = b"Transfer-Encoding: chunked\r\n\r\n"
CHUNK_BYTES = 1 << 15
SEGMENT_BYTES = 1 << 16
RECORDS_PER_FILE = 200_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD_SCHEMA = (
    "record_type string, record_id string, origin_id string, segment_number int, total_length long, "
    "page_id long, target_uri string, payload_digest string, refers_to long, block binary, problem string"
)
PAGE_SCHEMA = (
    "page_id long, target_uri string, record_type string, refers_to long, payload binary, payload_bytes long, "
    "payload_digest string, n_segments int, problem string"
)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- framing ---


def chunked(payload: bytes, chunk_bytes: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing; a chunk ends within each occurrence of the version text."""
    out, at = [], 0
    mark = payload.find(VERSION)
    while at < len(payload):
        end = min(at + chunk_bytes, len(payload))
        if mark >= 0 and mark + 5 <= end:
            end = mark + 5
            mark = payload.find(VERSION, end)
        out += (b"%x\r\n" % (end - at), payload[at:end], b"\r\n")
        at = end
    out.append(b"0\r\n\r\n")
    return b"".join(out)


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; raises ValueError where the framing is broken."""
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            raise ValueError("chunk size is missing")
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(out)
        if body[at + size: at + size + 2] != b"\r\n":
            raise ValueError("chunk is cut short")
        out.append(body[at: at + size])
        at += size + 2


# --- writing ---


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """A record without its closing line break, which the text writer adds."""
    head = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return b"%s\r\n%sContent-Length: %d\r\n\r\n%s\r\n" % (VERSION, head.encode(), len(block), block)


def _uri(url: str | None, page: object) -> str:
    """The address without characters that would end the header line."""
    if not url:
        return f"urn:x-page:{page}"
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def records_of(
    page_id: int | None, url: str | None, payload: bytes, origin: int | None, revisit: bool, name: str, segment_bytes: int
) -> Iterator[bytes]:
    """The records of one page: a revisit, a response, or a response and its continuations."""
    page = "" if page_id is None else page_id
    record_id = f"<urn:x-page:{page}:{name}>"
    common = [
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _uri(url, page)),
        ("X-Page-Id", page_id),
        ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if revisit:
        block = HTTP_HEAD + b"Content-Length: %d\r\n\r\n" % len(payload)
        refers = [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:x-page:{origin}>")]
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", record_id), *refers, *common], block)
        return
    block = HTTP_HEAD + CHUNKED + chunked(payload)
    first = [("WARC-Type", "response"), ("WARC-Record-ID", record_id), *common]
    if len(block) <= segment_bytes:
        yield _record(first, block)
        return
    for number, at in enumerate(range(0, len(block), segment_bytes), 1):
        segment = [("WARC-Segment-Number", number)]
        if number > 1:
            first = [
                ("WARC-Type", "continuation"),
                ("WARC-Record-ID", f"<urn:x-page:{page}:{name}.{number}>"),
                ("WARC-Segment-Origin-ID", record_id),
                ("WARC-Date", DATE),
            ]
            if at + segment_bytes >= len(block):
                segment.append(("WARC-Segment-Total-Length", len(block)))
        yield _record(first + segment, block[at: at + segment_bytes])


def write_archives(
    pages: DataFrame,
    folder: str,
    page: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_bytes: int = 0,
    segment_bytes: int = SEGMENT_BYTES,
    compression: str = "gzip",
) -> None:
    """Write the archives of all pages to ``folder``; equal payloads of ``least_bytes`` or more are written once."""
    rows = pages.select(
        F.col(page).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("sha", F.sha1("payload"))
    # Only payloads that occur again are joined back. The table is stored: small ones are then broadcast by
    # their true size, and a shuffled join can be split where one payload holds many rows.
    repeated = rows.groupBy("sha").agg(F.min("page_id").alias("origin"), F.count("*").alias("n")).where("n > 1")
    repeated = store(repeated.select("sha", "origin"), "warc_repeated")
    again = (F.octet_length("payload") >= least_bytes) & F.col("origin").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("origin"))
    rows = rows.join(repeated, "sha", "left").select("page_id", "url", "payload", "origin", again.alias("revisit"))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, nth = TaskContext.get().partitionId(), 0
        for batch in steps(batches, "payload"):
            out = []
            for page_id, address, body, origin, revisit in zip(*(c.to_pylist() for c in batch.columns)):
                out += records_of(page_id, address, body, origin, revisit, f"{task}.{nth}", segment_bytes)
                nth += 1
            yield pa.record_batch([pa.array(out, pa.binary())], ["record"])

    (
        rows.mapInArrow(records, "record binary")
        .select(F.col("record").cast("string").alias("value"))
        .write.option("lineSep", "\r\n")
        .option("compression", compression)
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(folder)
    )


# --- reading ---


def parse(record: bytes) -> dict | None:
    """The header fields and block of a record whose first line is already cut off; None for an empty one."""
    if not record.strip():
        return None
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n"):
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    length = int(fields.get("content-length", "0"))
    problem = None if len(rest) >= length and not rest[length:].strip() else "block length"
    refers = fields.get("warc-refers-to", "").strip("<>").rpartition(":")[2]
    number, total, page = (fields.get(k) for k in ("warc-segment-number", "warc-segment-total-length", "x-page-id"))
    return {
        "record_type": fields.get("warc-type"),
        "record_id": fields.get("warc-record-id"),
        "origin_id": fields.get("warc-segment-origin-id", fields.get("warc-record-id")),
        "segment_number": int(number) if number else None,
        "total_length": int(total) if total else None,
        "page_id": int(page) if page else None,
        "target_uri": fields.get("warc-target-uri"),
        "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        "refers_to": int(refers) if refers.lstrip("-").isdigit() else None,
        "block": rest[:length],
        "problem": problem,
    }


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of all archives, continuations still apart."""
    lines = spark.read.option("lineSep", SEPARATOR).text(folder).select(F.col("value").cast("binary").alias("value"))
    schema = spark.createDataFrame([], RECORD_SCHEMA).schema

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "value"):
            found = [r for r in map(parse, batch.column(0).to_pylist()) if r]
            yield _batch(found, schema.names, _RECORD_TYPES)

    return lines.mapInArrow(parsed, RECORD_SCHEMA)


_RECORD_TYPES = [
    pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(),
    pa.binary(), pa.string(),
]
_PAGE_TYPES = [
    pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.int32(), pa.string(),
]
_PAGE_NAMES = [field.split()[0] for field in PAGE_SCHEMA.split(", ")]


def _batch(rows: list[dict], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r[n] for r in rows], t) for n, t in zip(names, types)], names=names)


def decode(first: dict, block: bytes, n_segments: int, problem: str | None) -> dict:
    """The page of a whole block: payload, its length and digest."""
    head, _, body = block.partition(b"\r\n\r\n")
    row = {k: first[k] for k in ("page_id", "target_uri", "record_type", "refers_to", "payload_digest")}
    if first["record_type"] == "revisit":
        length = re.search(rb"(?im)^content-length:\s*(\d+)", head)
        size = int(length[1]) if length else None
        return row | {"payload": None, "payload_bytes": size, "n_segments": 1, "problem": problem}
    payload = body
    if re.search(rb"(?im)^transfer-encoding:\s*chunked", head):
        try:
            payload = dechunked(body)
        except ValueError as error:
            problem = problem or str(error)
    digest = payload_digest(payload)
    if digest != row["payload_digest"]:
        problem = problem or "payload digest"
    return row | {
        "payload": payload, "payload_bytes": len(payload), "payload_digest": digest, "n_segments": n_segments,
        "problem": problem,
    }


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """One row per page of the archives, segments joined and framing decoded.

    Only segmented records are shuffled, by the id of their first record.
    """
    records = read_records(spark, folder)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "block"):
            rows = [decode(r, r["block"], 1, r["problem"]) for r in batch.to_pylist()]
            yield _batch(rows, _PAGE_NAMES, _PAGE_TYPES)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for segments in column(batch, "segments"):
                parts = sorted(segments.as_py(), key=lambda r: r["segment_number"])
                block = b"".join(p["block"] for p in parts)
                problem = next((p["problem"] for p in parts if p["problem"]), None)
                if [p["segment_number"] for p in parts] != list(range(1, len(parts) + 1)):
                    problem = problem or "segment is missing"
                elif parts[-1]["total_length"] != len(block):
                    problem = problem or "total length"
                yield _batch([decode(parts[0], block, len(parts), problem)], _PAGE_NAMES, _PAGE_TYPES)

    single = records.where("segment_number is null").mapInArrow(whole, PAGE_SCHEMA)
    segments = records.where("segment_number is not null")
    groups = segments.groupBy("origin_id").agg(
        F.collect_list(F.struct(*[c for c in records.columns if c not in ("origin_id", "record_id")])).alias("segments")
    )
    return single.unionByName(groups.select("segments").mapInArrow(joined, PAGE_SCHEMA))
