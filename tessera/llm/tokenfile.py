"""Token-id files: flat unsigned integers with 64-bit document offsets, to be memory-mapped.

Ids ascend through the range partitions of the id column, and through the files of a partition:

    ids       unsigned little-endian integers, 2 bytes each if the vocabulary allows (else 4), every
              document followed by the end id; zero bytes up to a multiple of 8
    offsets   int64 x (documents + 1): where each document starts in this file, then the end
    doc_ids   int64 x documents
    has_id    one byte per document (0: its id is null); zero bytes up to a multiple of 8
    footer    int64 x 3: documents, ids, bytes per id
    tail      one newline, written by the text writer after its only row

A task starts a new file whenever the last one stands for ``part_bytes`` of text, so a partition may be
of any size. Files go through Spark's text writer, so any file system that Spark writes to will do. What
lies before a file (its base) is a prefix sum: over the partitions, whose number is bounded, and inside
each partition over its files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tessera.llm.tokens import SLICE_BYTES, in_slices, with_end, worker_encoder
from tessera.llm.workspace import Workspace, bounded

PART_BYTES = 16 << 20  # UTF-8 bytes of text that one file stands for, on average
MAX_PARTS = 16_384  # range partitions at most; beyond it tasks get more streams, not more memory
ROW_BYTES = 8  # what a row counts for beside its text
FILES = 1_000_000  # more than a task can write (the writer's own limit)


def in_id_order(docs: DataFrame, id_col: str, text_col: str, part_bytes: int, max_parts: int = MAX_PARTS) -> DataFrame:
    """(id long, text string) in ascending order of ids through range partitions of about ``part_bytes``.

    Null ids come first, a null text is empty. Rows of one id go by a hash of their text, rows equal in
    both as they come. All of these are keys of the ranges, so neither one id nor copies of one row
    fill a partition.
    The rows of ``docs`` must come in the same order whenever a task is run again (a scan does).
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text") + F.lit(ROW_BYTES))).first()[0] or 0
    parts = min(max_parts, max(1, -(-int(total) // part_bytes)))
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("came", F.monotonically_increasing_id())
    return (rows.repartitionByRange(parts, "id", "tie", "came")
            .sortWithinPartitions("id", "tie", "came").select("id", "text"))


def _pad8(data: bytes) -> bytes:
    return data + bytes(-len(data) % 8)


def file_bytes(ids: np.ndarray, offsets: np.ndarray, doc_ids: pa.Array) -> bytes:
    """The content of one file but for the tail."""
    known = doc_ids.is_valid().to_numpy(zero_copy_only=False)
    numbers = doc_ids.fill_null(0).cast(pa.int64()).to_numpy()
    footer = np.array([len(numbers), len(ids), ids.dtype.itemsize], "<i8")
    return b"".join([_pad8(ids.tobytes()), offsets.astype("<i8").tobytes(), numbers.astype("<i8").tobytes(),
                     _pad8(known.astype("u1").tobytes()), footer.tobytes()])


def encode_streams(batches: Iterator[pa.RecordBatch], vocabulary: str, end_id: int,
                   limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """(ids with end ids, offsets, document ids) of consecutive (id, text) rows, about ``limit`` bytes of text at a time."""
    encoder = worker_encoder(vocabulary)
    ids, sizes, numbers, held = [], [np.zeros(1, np.int64)], [], 0
    for b in batches:
        for at, part in in_slices(b.column(1), min(limit, SLICE_BYTES)):
            found, offsets = with_end(*encoder.encode(part), end_id)
            ids.append(found)
            sizes.append(np.diff(offsets))
            numbers.append(b.column(0).slice(at, len(part)))
            held += pc.sum(pc.binary_length(part)).as_py() + ROW_BYTES * len(part)
            if held >= limit:
                yield np.concatenate(ids), np.cumsum(np.concatenate(sizes)), pa.concat_arrays(numbers)
                ids, sizes, numbers, held = [], [np.zeros(1, np.int64)], [], 0
    if ids:
        yield np.concatenate(ids), np.cumsum(np.concatenate(sizes)), pa.concat_arrays(numbers)


def parse_file(data) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, offsets, doc_ids, has_id) as views of a file's bytes or of a memory map of it."""
    view = np.frombuffer(data, "u1") if not isinstance(data, np.ndarray) else data
    docs, n, width = view[-25:-1].view("<i8")
    at = int(n * width + (-n * width) % 8)
    offsets = view[at:at + 8 * (docs + 1)].view("<i8")
    at += 8 * int(docs + 1)
    return (view[: n * width].view(f"<u{width}"), offsets, view[at:at + 8 * docs].view("<i8"),
            view[at + 8 * docs: at + 9 * docs].astype(bool))


def open_mapped(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``parse_file`` over a memory map, for a trainer that mounts the folder."""
    return parse_file(np.memmap(path, "u1", "r"))


def write_token_files(docs: DataFrame, path: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                      end_id: int = 2, part_bytes: int = PART_BYTES, max_parts: int = MAX_PARTS) -> None:
    """Encodes every text (null: empty) and writes the files of ``docs`` under ``path``.

    Rows are in ascending order of the integer id, null ids first, repeated ids by a hash of their text
    (``in_id_order``). An empty table writes no document.
    """
    rows = in_id_order(docs, id_col, text_col, part_bytes, max_parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for stream in encode_streams(batches, vocabulary, end_id, part_bytes):
            yield pa.RecordBatch.from_arrays([pa.array([file_bytes(*stream)], pa.binary())], names=["content"])

    files = rows.mapInArrow(run, "content binary")
    with bounded(docs.sparkSession):
        (files.select(F.col("content").cast("string").alias("value")).write.mode("overwrite")
         .option("lineSep", "\n").option("maxRecordsPerFile", 1).text(path))


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(part, content): partition * ``FILES`` + number of the file in it, from the writer's names."""
    task, file = (F.regexp_extract("path", r"part-(\d+)-.*-c(\d+)", k).cast("long") for k in (1, 2))
    return spark.read.format("binaryFile").load(path).select((task * F.lit(FILES) + file).alias("part"), "content")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(part, place, doc_id, ids array<int>) of every document in the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, content in zip(b.column(0), b.column(1), strict=True):
                if len(data := content.as_buffer() or b"") < 24:
                    continue
                ids, offsets, numbers, known = parse_file(data)
                n = len(numbers)
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, part.as_py(), np.int64)), pa.array(np.arange(n)),
                                                  pa.array(numbers.astype(np.int64), mask=~known), lists], names=["part", "place", "doc_id", "ids"])

    return _files(spark, path).mapInArrow(run, "part long, place long, doc_id long, ids array<int>")


def token_file_index(spark: SparkSession, path: str, ws: Workspace) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, from the files alone.

    ``start`` counts all ids before the document, over all files; the checksum covers its ids as
    little-endian unsigned 32-bit integers, whatever their width in the file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, content in zip(b.column(0), b.column(1), strict=True):
                if len(data := content.as_buffer() or b"") < 24:
                    continue
                ids, offsets, numbers, known = parse_file(data)
                wide = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(wide[4 * s:4 * e]) for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(numbers), part.as_py(), np.int64)), pa.array(numbers.astype(np.int64), mask=~known),
                    pa.array(offsets[:-1].astype(np.int64)), pa.array(np.diff(offsets).astype(np.int64)), pa.array(crc, pa.int64())],
                    names=["part", "doc_id", "at", "n_tokens", "ids_crc32"])

    rows = ws.put(_files(spark, path).mapInArrow(run, "part long, doc_id long, at long, n_tokens long, ids_crc32 long"), "index")
    sizes = rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn("task", F.expr(f"part div {FILES}"))
    sizes = ws.put(sizes, "sizes")  # one row per file

    def before(w: Window):
        return F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    tasks = sizes.groupBy("task").agg(F.sum("n").alias("n")).select("task", before(Window.orderBy("task")).alias("base"))  # at most max_parts rows
    inner = sizes.select("task", "part", before(Window.partitionBy("task").orderBy("part")).alias("inner"))
    bases = inner.join(tasks, "task").select("part", (F.col("base") + F.col("inner")).alias("base"))
    return rows.join(bases, "part").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
