"""Turns of conversations in order, however many of them one conversation holds."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from tessera.llm.workspace import Workspace


def numbered(rows: DataFrame, group: str, keys: list[str | Column], ws: Workspace, name: str) -> DataFrame:
    """``rows`` plus ``pos``: the place (long, gapless from 0) inside the group in the order of ``keys``.

    Rows are sorted over range partitions, so a hot group spans many of them; a chunk of a group (its
    rows in one partition) starts after the rows of its earlier chunks, one row a chunk. Nulls come first,
    in the group column too (null is a group). Rows equal in all keys get neighbouring places in any order.
    """
    placed = (rows.repartitionByRange(group, *keys).sortWithinPartitions(group, *keys)
              .withColumn("__part", F.spark_partition_id())
              .withColumn("__at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    placed = ws.put(placed, f"{name}-placed")
    chunks = placed.groupBy(F.col(group).alias("__group"), F.col("__part").alias("__chunk")) \
        .agg(F.min("__at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("__group").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = ws.put(chunks.select("__group", "__chunk", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("__shift")),
                    f"{name}-chunks")
    return (placed.join(chunks, F.col("__part").eqNullSafe(F.col("__chunk")) & F.col(group).eqNullSafe(F.col("__group")))
            .withColumn("pos", F.col("__at") + F.col("__shift")).drop("__part", "__at", "__group", "__chunk", "__shift"))


def content_key(role: Column, text: Column) -> Column:
    """128 bits that stand for a turn's role and text."""
    return F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))


def streamed_sha256(pieces: DataFrame, key: str, order: list[str], piece: str, between: str) -> DataFrame:
    """(key, sha256 in lowercase hex) of each key's pieces in ``order``, with ``between`` between two of them.

    SHA-256 is sequential by definition: the pieces of one key stream through one task, a batch in memory at a
    time. Callers join rows to large pieces first, so that a hot key has few of them. A null key is a key.
    """
    kind = pieces.schema[key].dataType
    arrow = to_arrow_type(kind)
    names = [key, "sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for b in batches:
            keys, shas = [], []
            for k, x in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if state is None or k != now:
                    if state is not None:
                        keys.append(now)
                        shas.append(state.hexdigest())
                    now, state = k, hashlib.sha256()
                else:
                    state.update(between.encode())
                state.update(x.as_buffer())
            yield pa.RecordBatch.from_arrays([pa.array(keys, arrow), pa.array(shas, pa.string())], names=names)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], arrow), pa.array([state.hexdigest()], pa.string())], names=names)

    return (pieces.repartition(key).sortWithinPartitions(key, *order).select(key, piece)
            .mapInArrow(run, T.StructType([T.StructField(key, kind), T.StructField("sha256", T.StringType())])))
