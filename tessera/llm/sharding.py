"""Proportional stratified interleaving into shards.

Rows of each source are put in a seeded random order and get the fractional rank
(rank + 1/2) / rows of the source; all rows sorted by it interleave the sources in proportion, so
any contiguous cut holds the mixture. Both ranks are global positions in a range-partitioned order
(one offset per partition), never a window over a source, so a hot source spans many partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tessera.llm.workspace import Workspace


def global_position(df: DataFrame, keys: list[str], ws: Workspace, name: str) -> DataFrame:
    """``df`` plus ``pos`` (long, gapless from 0) in the order of ``keys``, written to the workspace.

    The written rows carry their partition and their place in it; the offsets are prefix sums over one
    row per partition. ``keys`` should tell all rows apart: a range can't divide equal rows.
    """
    placed = (df.repartitionByRange(*keys).sortWithinPartitions(*keys)
              .withColumn("__part", F.spark_partition_id())
              .withColumn("__at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    placed = ws.put(placed, name)
    sizes = placed.groupBy("__part").agg(F.count("*").alias("n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__base"))
    return (placed.join(bases, "__part")  # one row per partition
            .withColumn("pos", F.col("__base") + F.col("__at")).drop("__part", "__at", "__base"))


def stratified_shards(rows: DataFrame, ws: Workspace, id_col: str, source_col: str, text_col: str,
                      shards: int = 8, seed: int = 7) -> DataFrame:
    """(id, source, size, text_crc32, shard int, slot long) per row; shard sizes differ by at most one row.

    A null source is a source of its own; a null text is empty (size 1, crc32 0); null and repeated ids
    keep their rows. An empty table gives an empty result. ``size`` is the text's UTF-8 bytes plus 1.
    Rows equal in every column are told apart by the number they were written with.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = rows.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                       (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    base = base.withColumn("draw", F.xxhash64(F.lit(seed), "id", "text_crc32", "size"))
    base = ws.put(base.withColumn("came", F.monotonically_increasing_id()), "rows")
    tie = ["draw", "id", "text_crc32", "size", "came"]
    ranked = ws.put(global_position(base, ["source", *tie], ws, "by-source"), "ranked")
    stats = ws.put(ranked.groupBy("source").agg(F.min("pos").alias("start"), F.count("*").alias("n")), "sources")
    mixed = ranked.join(stats.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).select(
        "id", "source", "size", "text_crc32", "draw", "came",
        ((F.col("pos") - F.col("start") + 0.5) / F.col("n")).alias("share"))
    ordered = global_position(mixed, ["share", *tie, "source"], ws, "interleaved")
    total = ranked.count()
    # in integers: shard s begins at ceil(s * total / shards)
    out = ordered.withColumn("shard", F.expr(f"cast((pos * {shards}) div {max(total, 1)} as int)"))
    return out.select("id", "source", "size", "text_crc32", "shard",
                      (F.col("pos") - F.expr(f"(cast(shard as bigint) * {total} + {shards - 1}) div {shards}")).alias("slot"))
