"""SimHash near-duplicates with a covering family of bit masks.

A document's fingerprint is the bitwise majority of the XXH64 hashes of its word shingles.
Equal fingerprints are one node. For radius r every bit i gets a vector m(i) of r+1 bits; the
2^(r+1)-1 masks keep the bits with odd <m(i), v>. Any r differing bits leave some v orthogonal
to all of them, so every pair within the radius agrees under some mask: no link is missed.
A bucket beyond the run limit is not compared as a whole: it is dealt anew under masks that
also fix half of its free bits, again a covering family, until its buckets are small.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.llm.components import connected_components, smallest_linked
from tessera.llm.workspace import Workspace

SEED = 42
RUN_LIMIT = 1024  # rows of a bucket that are compared directly; larger ones are split by further masks


def fingerprint(text: bytes, shingle: int) -> int:
    """Signed 64-bit fingerprint of one UTF-8 text; 0 for a text without words."""
    import xxhash

    words = text.lower().split()  # on bytes: A-Z only, and exactly the six ASCII blanks
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    spans = list(zip(starts[: len(words) - k + 1].tolist(), ends[k - 1:].tolist(), strict=True))
    counts = np.zeros(64, np.int64)
    for at in range(0, len(spans), 65536):
        part = np.array([digest(line[s:e], 42) for s, e in spans[at:at + 65536]], "<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(spans), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(id, fp) per row of ``docs``; a null text counts as empty."""
    rows = docs.select(F.col(id_col).alias("id"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = pa.array([fingerprint(x, shingle) for x in b.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), fps], names=["id", "fp"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fp long")


@functools.cache
def spread_vectors(radius: int) -> list[int]:
    """The non-zero vectors of radius + 1 bits, each next one where the masks so far fix least; a basis comes first."""
    size = 1 << (radius + 1)
    order, weight = [], [0] * size
    while len(order) < size - 1:
        cost = lambda m: sum(2.0 ** -(weight[v] + (m & v).bit_count() % 2) for v in range(1, size))
        order.append(min((m for m in range(1, size) if m not in order), key=cost))
        weight = [w + (order[-1] & v).bit_count() % 2 for v, w in enumerate(weight)]
    return order


def covering_masks(bits: list[int], radius: int) -> list[int]:
    """Masks over the given bit positions: any ``radius`` of them are all left out by some mask.

    With more than ``radius`` positions every mask keeps one at least, so dealing anew always ends.
    """
    size, order = 1 << (radius + 1), spread_vectors(radius)
    spread = [order[i % len(order)] for i in range(len(bits))]
    return [sum(1 << b for b, m in zip(bits, spread, strict=True) if (m & v).bit_count() % 2) for v in range(1, size)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _pairs_in_runs(fp: np.ndarray, start: np.ndarray, length: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i < j) of one run that differ in at most ``bits`` bits."""
    left, right = [], []
    small = length <= 32
    run_end = np.repeat((start + length)[small], length[small])
    index = np.concatenate([np.arange(s, s + n) for s, n in zip(start[small], length[small], strict=True)]) if small.any() else np.empty(0, np.int64)
    d = 1
    while index.size:
        keep = index + d < run_end
        index, run_end = index[keep], run_end[keep]
        near = np.bitwise_count(fp[index] ^ fp[index + d]) <= bits
        left.append(index[near])
        right.append(index[near] + d)
        d += 1
    for s, n in zip(start[~small], length[~small], strict=True):
        part = fp[s:s + n]
        i, j = np.nonzero(np.triu(np.bitwise_count(part[:, None] ^ part[None, :]) <= bits, 1))
        left.append(i + s)
        right.append(j + s)
    empty = np.empty(0, np.int64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def _link_buckets(batches: Iterator[pa.RecordBatch], bits: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Sorted (path, key, fp) rows -> stars of linked fingerprints, or the rows of too large a bucket."""
    names = ["path", "a", "b"]

    def linked(path, key, fp):
        cut = np.flatnonzero(np.concatenate(([True], (path[1:] != path[:-1]) | (key[1:] != key[:-1]))))
        length = np.diff(np.concatenate((cut, [len(fp)])))
        keep = length > 1
        i, j = _pairs_in_runs(fp.view(np.uint64), cut[keep], length[keep], bits)
        if not i.size:
            return
        label = smallest_linked(len(fp), i, j)
        at = np.flatnonzero(label != np.arange(len(fp)))
        yield pa.RecordBatch.from_arrays([pa.nulls(len(at), pa.int64()), pa.array(fp[at]), pa.array(fp[label[at]])], names=names)

    def whole(path, fp):
        yield pa.RecordBatch.from_arrays([pa.array(path), pa.array(fp), pa.nulls(len(fp), pa.int64())], names=names)

    held = [np.empty(0, np.int64)] * 3
    passing = None  # the bucket whose rows are being handed on
    for b in batches:
        path, key, fp = (np.concatenate((h, c.to_numpy())) for h, c in zip(held, b.columns, strict=True))
        if passing is not None:
            n = int(np.argmin(np.append((path == passing[0]) & (key == passing[1]), False)))
            yield from whole(path[:n], fp[:n])
            path, key, fp = path[n:], key[n:], fp[n:]
            if not len(fp):
                held = [path, key, fp]
                continue
            passing = None
        last = len(fp) - int(np.argmin(np.append(((path == path[-1]) & (key == key[-1]))[::-1], False)))
        yield from _split(path[:last], key[:last], fp[:last], limit, linked, whole)
        held = [path[last:], key[last:], fp[last:]]
        if len(held[2]) > limit:
            passing = (held[0][0], held[1][0])
            yield from whole(held[0], held[2])
            held = [np.empty(0, np.int64)] * 3
    yield from _split(*held, limit, linked, whole)


def _split(path, key, fp, limit, linked, whole):
    """Runs within the limit are linked, the others handed on."""
    if not len(fp):
        return
    cut = np.flatnonzero(np.concatenate(([True], (path[1:] != path[:-1]) | (key[1:] != key[:-1]))))
    length = np.diff(np.concatenate((cut, [len(fp)])))
    large = np.repeat(length > limit, length)
    if large.any():
        yield from whole(path[large], fp[large])
    if not large.all():
        yield from linked(path[~large], key[~large], fp[~large])


def link_fingerprints(unique: DataFrame, ws: Workspace, max_bits: int, limit: int = RUN_LIMIT) -> DataFrame:
    """Distinct ``fp`` -> edges (a, b) that connect whatever pairs within ``max_bits`` connect."""
    limit = max(limit, 1 << max_bits)  # a bucket with no more than max_bits free bits is never larger
    masks = {t + 1: m for t, m in enumerate(covering_masks(list(range(64)), max_bits))}
    rows = unique.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).cast("long").alias("path"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
        for t, m in masks.items()])).alias("x")).select("x.path", "x.key", "fp")
    edges, level = None, 0
    while True:
        dealt = rows.repartition("path", "key").sortWithinPartitions("path", "key", "fp")
        found = ws.put(dealt.mapInArrow(lambda it: _link_buckets(it, max_bits, limit), "path long, a long, b long"), f"links-{level}")
        part = found.filter("b is not null").select("a", "b")
        edges = part if edges is None else edges.unionByName(part)
        over = found.filter("b is null").select("path", F.col("a").alias("fp"))
        if over.isEmpty():
            return edges
        level += 1
        paths = [r[0] for r in over.select("path").distinct().collect()]  # at most one per mask of the level
        finer, deeper = {}, {}
        for p in paths:  # numbered anew at each level, so that the numbers stay small
            free = [i for i in range(64) if not masks[p] >> i & 1]
            finer[p] = [(len(deeper) + t, masks[p] | m) for t, m in enumerate(covering_masks(free, max_bits))]
            deeper.update(finer[p])
        masks = deeper
        rows = deal_anew(over, finer)


def deal_anew(over: DataFrame, finer: dict[int, list[tuple[int, int]]]) -> DataFrame:
    """Rows of large buckets, once under each finer mask of their bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            path, fp = b.column(0).to_numpy(), b.column(1).to_numpy()
            for p in np.unique(path):
                own = fp[path == p]
                for number, m in finer[int(p)]:
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(own), number)),
                        pa.array(own & np.int64(_signed(m))), pa.array(own)], names=["path", "key", "fp"])

    return over.mapInArrow(run, "path long, key long, fp long")


def simhash_components(docs: DataFrame, ws: Workspace, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 4, max_bits: int = 4, limit: int = RUN_LIMIT) -> DataFrame:
    """(id, fp, component) per row; ``component`` is the smallest id reachable over links.

    Null and empty texts have fingerprint 0 and link like any other. A null id takes part in links but
    is never the smallest; a component of null ids only has a null component. Repeated rows stay.
    """
    prints = ws.put(fingerprints(docs, id_col, text_col, shingle), "prints")
    unique = ws.put(prints.groupBy("fp").agg(F.min("id").alias("first")), "unique")
    roots = connected_components(link_fingerprints(unique, ws, max_bits, limit), ws)
    linked = roots.withColumnRenamed("node", "fp").join(unique, "fp")
    least = linked.groupBy("root").agg(F.min("first").alias("component"))
    of_linked = ws.put(linked.join(least, "root").select("fp", "component"), "of-linked")
    by_fp = ws.put(unique.join(of_linked, "fp", "left")
                   .select("fp", F.when(F.col("component").isNull(), F.col("first")).otherwise(F.col("component")).alias("component")), "by-fp")
    return prints.join(by_fp, "fp").select("id", "fp", "component")


def simhash_dedup(spark: SparkSession, docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """Rows of ``docs`` without near copies: one row of each component stays.

    The row with the smallest (doc_id, text hash) of a component is kept, a row with a null doc_id only
    where no other exists. Columns, extra ones included, are returned unchanged.
    """
    ws = Workspace(spark, "simhash")
    # ids are made unique per (doc_id, text) so that repeated ids with other texts stay apart
    key = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"), F.xxhash64("text").alias("h"))
    flat = docs.select(key.alias("doc_id"), F.col("text").alias("text"))
    kept = (simhash_components(flat, ws, shingle=shingle, max_bits=max_bits)
            .filter(F.col("id") == F.col("component")))
    kept = ws.put(kept.groupBy("id").agg(F.count("*").alias("copies")).select(F.col("id.n").alias("__n"), F.col("id.i").alias("__i"), F.col("id.h").alias("__h"), F.col("copies").alias("__c")), "kept")
    on = (F.col("doc_id").isNull() == F.col("__n")) & F.col("doc_id").eqNullSafe(F.col("__i")) & (F.xxhash64("text") == F.col("__h"))
    rows = docs.join(kept, on)
    once = rows.filter("__c = 1").select(*[docs[c] for c in docs.columns])
    twins = rows.filter("__c > 1").dropDuplicates(["__n", "__i", "__h"]).select(*[docs[c] for c in docs.columns])
    return once.unionByName(twins)
