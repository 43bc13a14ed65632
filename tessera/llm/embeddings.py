"""Embedding near-duplicates through randomised-rotation binary codes.

Vectors are normalised, equal ones of a label become one class. For every class are stored, once: its binary code (the
signs of its coordinates after a seeded random rotation, a bit each), the correction factor f = <code, x>, and the
rotated vector in a byte a coordinate with its step. Classes that agree in all bits of some table of further rotations
meet in a bucket; the number of bits follows the size of the largest label and the number of tables from the wanted
miss rate, so buckets stay small and a pair at the threshold is missed with a chance below ``MISS``.

Only what is stored goes to the buckets. There <code, y> / f is an unbiased estimate of <x, y>; its error is
at most sqrt(1 - f^2) / f * sqrt(1 - t^2) at the threshold t, and that of the byte coordinates at most half a step a
coordinate. Pairs whose upper bound stays below the threshold are done. Vectors are fetched for the rest only, a row
for each class that still has a partner in its bucket, and their pairs are computed exactly, in double precision. (The
lower bound of a code of this length can't reach the threshold unless vectors are equal, and those are one class.)

A bucket over ``BLOCK`` rows is dealt out as pairs of blocks, each a task's unit of its own. A pair is
taken in the first table where it meets, so links are counted once without listing pairs: each bucket
returns link counts per vector and a spanning star per group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm.components import connected_components, smallest_linked
from tessera.llm.workspace import Workspace

MISS = 1e-7  # chance to miss a pair whose cosine is the threshold
BLOCK = 2048  # rows of a bucket compared in one unit
PER_BUCKET = 32  # wanted rows of the largest label per bucket
SEED = 20


def rotations(dim: int, count: int, seed: int = SEED) -> np.ndarray:
    """``count`` random orthogonal matrices, (count, dim, dim)."""
    rng = np.random.default_rng([seed, dim])
    out = np.empty((count, dim, dim))
    for k in range(count):
        q, r = np.linalg.qr(rng.standard_normal((dim, dim)))
        out[k] = q * np.sign(np.diag(r))
    return out


def table_shape(largest: int, threshold: float, miss: float = MISS) -> tuple[int, int]:
    """(bits per table, tables) for a label of ``largest`` classes."""
    agree = 1 - math.acos(min(1.0, threshold)) / math.pi
    bits = min(48, max(4, math.ceil(math.log2(max(2, largest) / PER_BUCKET)) if largest > PER_BUCKET else 4))
    if agree >= 1:
        return bits, 1
    return bits, max(1, math.ceil(math.log(miss) / math.log1p(-(agree ** bits))))


def table_keys(unit: np.ndarray, bits: int, tables: int, seed: int = SEED) -> np.ndarray:
    """(rows, tables) int64: the sign bits of each table's coordinates of rotated unit vectors."""
    dim = unit.shape[1]
    need = bits * tables
    signs = np.concatenate([unit @ r.T > 0 for r in rotations(dim, -(-need // dim), seed)], axis=1)[:, :need]
    return signs.reshape(len(unit), tables, bits) @ (1 << np.arange(bits, dtype=np.int64))


def code_factor(rotated: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, factors): signs over sqrt(dim), and the inner product of each vector with its own code."""
    code = np.where(rotated > 0, 1.0, -1.0) / math.sqrt(rotated.shape[1])
    return code, np.einsum("ij,ij->i", code, rotated)


def may_link(codes: np.ndarray, factors: np.ndarray, others: np.ndarray, threshold: float) -> np.ndarray:
    """Where estimate plus error bound reaches the threshold; (len(codes), len(others))."""
    estimate = (codes @ others.T) / factors[:, None]
    error = np.sqrt(np.maximum(0, 1 - factors ** 2)) / factors * math.sqrt(max(0.0, 1 - threshold ** 2))
    return estimate + error[:, None] >= threshold - 1e-9


def stored_codes(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(packed code bits, factors, steps, byte coordinates) of unit vectors."""
    rotated = unit @ rotations(unit.shape[1], 1, SEED + 1)[0].T
    _, factors = code_factor(rotated)
    steps = np.abs(rotated).max(axis=1) / 127
    return np.packbits(rotated > 0, axis=1), factors, steps, np.rint(rotated / steps[:, None]).astype(np.int8)


def may_link_stored(bits: np.ndarray, factors: np.ndarray, steps: np.ndarray, coordinates: np.ndarray, threshold: float) -> np.ndarray:
    """``may_link`` from what is stored of x (bits, factors) and y (steps, byte coordinates): never less than it says."""
    dim = coordinates.shape[1]
    signs = np.unpackbits(bits, axis=1, count=dim).astype(np.float32) * 2 - 1
    products = (signs @ coordinates.T.astype(np.float32)).astype(float)  # whole numbers that float32 holds
    estimate = products * steps[None, :] / math.sqrt(dim) / factors[:, None]
    error = np.sqrt(np.maximum(0, 1 - factors ** 2)) / factors * math.sqrt(max(0.0, 1 - threshold ** 2))
    rounding = math.sqrt(dim) * steps[None, :] / 2 / factors[:, None]
    return estimate + error[:, None] + rounding >= threshold - 1e-9


def linked_pairs(x: np.ndarray, xk: np.ndarray, y: np.ndarray, yk: np.ndarray, table: int, rotation: np.ndarray,
                 threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) with cosine >= threshold of rows x and y that meet in no table before ``table``."""
    codes, factors = code_factor(x @ rotation.T)
    i, j = np.nonzero(may_link(codes, factors, y @ rotation.T, threshold))
    if table and len(i):
        fresh = ~(xk[i, :table] == yk[j, :table]).any(axis=1)
        i, j = i[fresh], j[fresh]
    exact = np.einsum("ij,ij->i", x[i], y[j]) >= threshold if len(i) else np.empty(0, bool)
    return i[exact], j[exact]


def embedding_links(rows: DataFrame, ws: Workspace, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", threshold: float = 0.98, miss: float = MISS, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row; only vectors of equal, non-null labels are compared.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows without label, have
    no links. Vectors of other lengths never link. Null ids take part but are never a component's smallest;
    repeated rows are vectors of their own. An empty table gives an empty result.
    """
    base = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).alias("label"))
    sane = F.col("label").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) \
        & F.exists("v", lambda x: x != 0)
    base = base.withColumn("sane", F.coalesce(sane, F.lit(False)))
    base = base.withColumn("v", F.when(F.col("sane"), F.transform("v", lambda x: x + F.lit(0.0))))  # -0.0 is 0.0
    base = base.withColumns({"h1": F.when(F.col("sane"), F.xxhash64("label", "v")), "h2": F.when(F.col("sane"), F.xxhash64(F.lit(SEED), "v", "label"))})
    base = ws.put(base, "base")
    # equal vectors of a label are one class; its key is 128 bits of both, its content travels once
    classes = base.filter("sane").groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("id").alias("first"), F.first("v").alias("v"), F.first("label").alias("label"))
    classes = ws.put(classes.withColumns({"h": F.monotonically_increasing_id(), "dim": F.size("v")}), "classes")
    spaces = ws.put(classes.groupBy("label", "dim").agg(F.count("*").alias("size")).withColumn("space", F.monotonically_increasing_id()), "spaces")
    bits, tables = table_shape(int(spaces.agg(F.max("size")).first()[0] or 0), threshold, miss)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            sizes = lists.value_lengths().to_numpy()
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                unit = normalised(lists.take(pa.array(at)).flatten().to_numpy().reshape(len(at), dim))
                keys = table_keys(unit, bits, tables)
                for t in range(tables):
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array(np.full(len(at), t, np.int32)),
                                                      b.column(2).take(pa.array(at)), pa.array(keys[:, t])], names=["h", "t", "space", "key"])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            sizes = lists.value_lengths().to_numpy()
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                code, factor, step, q = stored_codes(normalised(lists.take(pa.array(at)).flatten().to_numpy().reshape(len(at), dim)))
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array([x.tobytes() for x in code], pa.binary()), pa.array(factor),
                                                  pa.array(step), pa.array([x.tobytes() for x in q], pa.binary())], names=["h", "code", "factor", "step", "q"])

    stored = ws.put(classes.select("h", "v").mapInArrow(coded, "h long, code binary, factor double, step double, q binary"), "stored")
    codes = classes.join(spaces.select("label", "dim", "space"), ["label", "dim"]).select("h", "v", "space")
    codes = ws.put(codes.mapInArrow(keyed, "h long, t int, space long, key long"), "codes")
    full = codes.groupBy("t", "space", "key").agg(F.count("*").alias("n")).filter("n > 1")
    full = ws.put(full.withColumn("blocks", F.ceil(F.col("n") / block).cast("int")), "buckets")
    placed = codes.join(full, ["t", "space", "key"]).withColumn("mine", F.pmod(F.xxhash64("h"), F.col("blocks")).cast("int"))
    # a unit is a pair of blocks; a row goes to every unit that holds its block
    units = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = units.select("t", "space", "key", "h", "mine", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"))
    unit = ["t", "space", "key", "lo", "hi"]

    def together(df: DataFrame, *columns) -> DataFrame:
        placed_ = df.repartition(*unit).sortWithinPartitions(*unit, "h")
        return placed_.select(*unit, "h", F.col("mine").alias("mine"), *columns)

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in units_of(batches):
            code, q = (np.frombuffer(b"".join(b.column(k).to_pylist()), kind).reshape(b.num_rows, -1) for k, kind in ((7, np.uint8), (10, np.int8)))
            factor, step = b.column(8).to_numpy(), b.column(9).to_numpy()
            low = b.column(6).to_numpy() == b.column(3)[0].as_py()
            if b.column(3)[0].as_py() == b.column(4)[0].as_py():
                may = may_link_stored(code, factor, step, q, threshold)
                np.fill_diagonal(may, False)
                keep = may.any(axis=0) | may.any(axis=1)
            else:
                x, y = np.flatnonzero(low), np.flatnonzero(~low)
                may = may_link_stored(code[x], factor[x], step[y], q[y], threshold)
                keep = np.zeros(b.num_rows, bool)
                keep[x], keep[y] = may.any(axis=1), may.any(axis=0)
            if keep.any():
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep)) for c in b.columns[:7]], names=[*unit, "h", "mine"])

    carried = together(units.join(stored, "h"), "code", "factor", "step", "q")
    near = ws.put(carried.mapInArrow(estimate, "t int, space long, key long, lo int, hi int, h long, mine int"), "near")
    fetched = together(near.join(classes.select("h", "v", "n"), "h"), "n", "v")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in units_of(batches):
            table, h, n = b.column(0)[0].as_py(), b.column(5).to_numpy(), b.column(7).to_numpy().astype(float)
            alone = b.column(3)[0].as_py() == b.column(4)[0].as_py()
            low = b.column(6).to_numpy() == b.column(3)[0].as_py()
            unit = normalised(b.column(8).flatten().to_numpy().reshape(b.num_rows, -1))
            keys = table_keys(unit, bits, tables)
            turn = rotations(unit.shape[1], 1, SEED + 1)[0]
            if alone:
                i, j = linked_pairs(unit, keys, unit, keys, table, turn, threshold)
                i, j = i[i < j], j[i < j]
            else:
                a, b = np.flatnonzero(low), np.flatnonzero(~low)
                i, j = linked_pairs(unit[a], keys[a], unit[b], keys[b], table, turn, threshold)
                i, j = a[i], b[j]
            if len(i):
                links = np.bincount(i, n[j], len(h)) + np.bincount(j, n[i], len(h))
                root = smallest_linked(len(h), i, j)
                at = np.flatnonzero(links > 0)
                yield pa.RecordBatch.from_arrays([pa.array(h[at]), pa.array(links[at].astype(np.int64)), pa.array(h[root[at]])], names=["h", "links", "near"])

    found = ws.put(fetched.mapInArrow(compare, "h long, links long, near long"), "found")
    roots = connected_components(found.select(F.col("h").alias("a"), F.col("near").alias("b")), ws)
    linked = ws.put(found.groupBy("h").agg(F.sum("links").alias("links")).join(roots.withColumnRenamed("node", "h"), "h"), "linked")
    least = linked.join(classes.select("h", "first"), "h").groupBy("root").agg(F.min("first").alias("component"))
    verdict = classes.select("h", "h1", "h2", "n", "first").join(linked.join(least, "root"), "h", "left")
    verdict = ws.put(verdict.select("h1", "h2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                                    F.coalesce("component", "first").alias("component")), "verdict")
    out = base.select("id", "h1", "h2").join(verdict, ["h1", "h2"], "left")
    component = F.when(F.col("h1").isNull(), F.col("id")).otherwise(F.col("component"))
    return out.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def normalised(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def units_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each unit (t, space, key, lo, hi: the first five columns) of sorted rows, as one batch."""
    held: list[pa.RecordBatch] = []

    def name(b: pa.RecordBatch, k: int) -> tuple:
        return tuple(c[k].as_py() for c in b.columns[:5])

    for b in batches:
        if not b.num_rows:
            continue
        new = np.zeros(b.num_rows - 1, bool)
        for c in b.columns[:5]:
            x = c.to_numpy()
            new |= x[1:] != x[:-1]
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), b.num_rows]
        for s, e in zip(cuts, cuts[1:], strict=False):
            if held and name(held[0], 0) != name(b, s):
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
            held.append(b.slice(s, e - s))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
