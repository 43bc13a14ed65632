"""WARC archives with revisit records.

Headers (id, payload digest, payload size) are shuffled by digest; the smallest id of a digest is the
response, other records with it become revisits that refer to it, and the archives are written with
fresh headers. Digest groups are reduced by a partial aggregate and joined back from a written table,
so a payload that a third of the pages share is split like any hot join key.

An archive opens with a warcinfo record, and every record is a gzip member of its own, so a reader can
seek to it by the offset that ``read_archives`` returns. Archives go through Spark's text writer, so any
file system that Spark writes to will do: a row is a whole archive, and the writer's line separator, one
zero byte, is padding that gzip readers skip (the names end in ``.txt``, the writer's own choice). The
reader goes by Content-Length, so a payload may hold any bytes, blank lines and WARC headers included.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tessera.llm.workspace import Workspace, bounded

CRLF = "\r\n"
RECORD_END = CRLF + CRLF
FILE_BYTES = 16 << 20  # uncompressed bytes after which a task starts a new archive
CHUNK = 1 << 14  # bytes given to the decompressor at a time
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"  # the table has no capture time


def base32(hex_digest: Column) -> Column:
    """Upper-case base32 of a 40-digit hex string: eight groups of 20 bits, four letters each."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    out = []
    for k in range(8):
        group = F.conv(F.substring(hex_digest, 5 * k + 1, 5), 16, 10).cast("int")
        out += [F.substring(letters, F.shiftright(group, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def record_id(page_id: Column, digest: Column) -> Column:
    """A name-based record id: the same page and payload always get the same one."""
    h = F.md5(F.concat_ws(":", F.lit("page"), F.coalesce(page_id.cast("string"), F.lit("null")), digest))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def resolve(headers: DataFrame, ws: Workspace, min_bytes: int = 0) -> DataFrame:
    """(id, digest, size) -> plus ``refers_to``: null for responses, else the id of the response.

    A null id never is the response of others; rows that repeat the response's id are responses too, and
    so are all rows of a digest whose ids are all null, and payloads below ``min_bytes``.
    """
    headers = ws.put(headers, "headers")
    large = headers.filter(F.col("size") >= min_bytes)
    first = ws.put(large.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"), "first")
    joined = headers.join(first, "digest", "left")
    refers = F.when((F.col("size") >= min_bytes) & ~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    return joined.select("id", "digest", "size", refers.alias("refers_to"))


def member(record: bytes) -> bytes:
    """One record, with the two line ends that close it, as a gzip member."""
    return gzip.compress(record + RECORD_END.encode(), 6, mtime=0)


def members(data) -> Iterator[tuple[int, int, bytes]]:
    """(offset, compressed length, content) of every gzip member of an archive, up to its zero padding."""
    view, at = memoryview(data), 0
    while at < len(view) and view[at]:
        reader, stop, content = zlib.decompressobj(31), at, []
        while not reader.eof:
            if stop >= len(view):
                raise ValueError(f"the gzip member at {at} is cut short")
            content.append(reader.decompress(view[stop:stop + CHUNK]))
            stop = min(stop + CHUNK, len(view))
        stop -= len(reader.unused_data)
        yield at, stop - at, b"".join(content)
        at = stop


def archives_of(records: Iterator[bytes], file_bytes: int) -> Iterator[bytes]:
    """Archives of consecutive records: a warcinfo record, then about ``file_bytes`` of them before compression."""
    held, size = [], 0
    for record in records:
        if not held:
            block = b"software: tessera\r\nformat: WARC File Format 1.1\r\n"
            held.append(member(CRLF.join((
                "WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.UUID(bytes=hashlib.md5(record).digest())}>", f"WARC-Date: {DATE}",
                "Content-Type: application/warc-fields", f"Content-Length: {len(block)}")).encode() + RECORD_END.encode() + block))
        held.append(member(record))
        size += len(record)
        if size >= file_bytes:
            yield b"".join(held)
            held, size = [], 0
    if held:
        yield b"".join(held)


def write_archives(pages: DataFrame, path: str, ws: Workspace, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> None:
    """One WARC/1.1 record per row under ``path``; a null payload is empty, a null url an empty URI.

    Blanks and control characters can't stand in a header line and are taken out of URIs. An empty table
    gives no archive.
    """
    payload = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    headers = pages.select(F.col(id_col).cast("long").alias("id"), base32(F.sha1(payload)).alias("digest"),
                           F.octet_length(payload).cast("long").alias("size"))
    resolved = ws.put(resolve(headers, ws, min_bytes), "resolved")
    # rows of one id may differ in payload, hence the digest in the key; equal rows are equal records
    flags = ws.put(resolved.groupBy("id", "digest").agg(F.max("refers_to").alias("refers_to")), "flags")
    bodies = pages.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"),
                          F.coalesce(F.col(payload_col), F.lit("")).alias("body"))
    bodies = bodies.withColumn("digest", base32(F.sha1(F.encode("body", "UTF-8"))))
    rows = bodies.join(flags.withColumnsRenamed({"id": "of", "digest": "is"}),
                       F.col("id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("is")))
    revisit = F.col("refers_to").isNotNull()
    size = F.octet_length("body").cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit(RECORD_END))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("body")))
    uri = F.regexp_replace("url", r"[\x00-\x20\x7f]", "")
    lines = F.concat_ws(
        CRLF, F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), record_id(F.col("id"), F.col("digest"))), F.concat(F.lit("WARC-Target-URI: "), uri),
        F.lit(f"WARC-Date: {DATE}"), F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.concat(F.lit("X-Page-ID: "), F.coalesce(F.col("id").cast("string"), F.lit(""))),
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {REVISIT_PROFILE}\r\nWARC-Refers-To: "), record_id(F.col("refers_to"), F.col("digest")))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for archive in archives_of((v.as_buffer().to_pybytes() for b in batches for v in b.column(0)), file_bytes):
            yield pa.RecordBatch.from_arrays([pa.array([archive], pa.binary())], names=["archive"])

    archives = rows.select(F.concat(lines, F.lit(RECORD_END), block).alias("value")).mapInArrow(run, "archive binary")
    with bounded(pages.sparkSession):
        (archives.select(F.col("archive").cast("string").alias("value")).write.mode("overwrite")
         .option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path))


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of every record of uncompressed archive data."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = dict(line.split(": ", 1) for line in data[at:end].decode("utf-8").split(CRLF)[1:])
        head = {k.lower(): v for k, v in head.items()}
        start = end + 4
        stop = start + int(head["content-length"])
        yield head, data[start:stop]
        at = stop + 4


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, record_type, page_id, uri, declared_digest, refers_to_id, payload, payload_bytes, payload_digest,
    file, member_at, member_bytes) of every response and revisit.

    Size and digest are computed from the payload that was read; a revisit's own payload is empty. The last
    three say where the record's gzip member lies.
    """
    schema = ("record_id string, record_type string, page_id long, uri string, declared_digest string, "
              "refers_to_id string, payload binary, payload_bytes long, payload_digest string, file string, member_at long, member_bytes long")
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows = []
                for at, length, data in members(content.as_buffer()):
                    head, block = next(parse_records(data))
                    if head["warc-type"] == "warcinfo":
                        continue
                    body = block[block.index(b"\r\n\r\n") + 4:]
                    page = head.get("x-page-id") or None
                    rows.append((head["warc-record-id"], head["warc-type"], page and int(page), head["warc-target-uri"],
                                 head["warc-payload-digest"].removeprefix("sha1:"), head.get("warc-refers-to"), body, len(body),
                                 base64.b32encode(hashlib.sha1(body).digest()).decode(), file, at, length))
                if rows:
                    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(),
                             pa.string(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    files = spark.read.format("binaryFile").load(path).filter("length > 1").select("path", "content")
    return files.mapInArrow(run, schema)


def resolved_index(spark: SparkSession, path: str, ws: Workspace) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) per record of the archives.

    Revisits take size and digest from the payload of the response that they refer to.
    """
    records = ws.put(read_archives(spark, path).drop("payload", "uri", "declared_digest", "file", "member_at", "member_bytes"), "records")
    own = records.filter("record_type = 'response'")
    originals = ws.put(own.groupBy("record_id", "payload_digest").agg(F.min("page_id").alias("refers_to"), F.first("payload_bytes").alias("b")), "originals")
    revisits = records.filter("record_type = 'revisit'").select("page_id", "refers_to_id", "record_type", F.col("payload_digest").alias("d"))
    found = revisits.join(originals, F.col("refers_to_id") == F.col("record_id"))
    return (own.select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
            .unionByName(found.select("page_id", F.col("b").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")))
