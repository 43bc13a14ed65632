"""Skew-safe positional primitives.

A window ``partitionBy(g).orderBy(o)`` sends a whole group to one task, and a
window with no partition sends the whole table to one task. These helpers give
the same numbers with work split evenly:

* ``with_global_index`` range-partitions on a total order, numbers rows inside
  each partition and adds the row count of all earlier partitions (a table with one
  row per partition; its join is left to the run-time size check).
* ``rank_in_groups`` subtracts the group's first global index (a partial
  aggregate, so a hot group is combined map-side).
* ``neighbour`` fetches the previous/next row of the same group with an equi
  join on the unique global index, so a hot group spreads over all tasks.

The range-partitioned, sorted rows are checkpointed once into the shared folder and read by
both the counting branch and the numbering branch. Spark samples range bounds per exchange
instance (the sample seed depends on the RDD id), so two separately planned exchanges may cut
the data differently; one written copy gives both branches the same partitions and survives
the loss of executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage, shuffle_partitions

def settled(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder.

    Used for a per-group aggregate that is joined back to its rows: both sides of the join are then
    plain exchanges, which adaptive execution splits when a key is hot (an aggregate right above
    the exchange keeps it from doing so).
    """
    return cut_lineage(df)


def join_same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi join on columns of the same name in which a null key equals a null key; the keys of ``left`` stay.

    A group whose key is null is a group like any other, as it is for ``groupBy`` and windows."""
    other = right.withColumnsRenamed({k: "_same_" + k for k in keys})
    cond = [F.col(k).eqNullSafe(F.col("_same_" + k)) for k in keys]
    return left.join(other, cond, how).drop(*["_same_" + k for k in keys])


def md5_order(id_col, seed: str) -> Column:
    """Reproducible pseudo-random sort key: md5 of id || seed (same hex in DuckDB)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(c.cast("string"), F.lit(str(seed))))


def with_global_index(df: DataFrame, order: list, name: str = "_gidx",
                      num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 0-based position of each row in the total order ``order``.

    Nulls come first. Rows equal in ``order`` get neighbouring numbers as they come (many equal rows still
    spread over several partitions); the rows are written once with their numbers.
    """
    n = num_partitions or shuffle_partitions(df.sparkSession)
    order = [*order, F.col("_came")]
    ordered = (df.withColumn("_came", F.monotonically_increasing_id())
               .repartitionByRange(n, *order)
               .sortWithinPartitions(*order).drop("_came")
               .withColumn("_pid", F.spark_partition_id())
               .withColumn("_local", F.monotonically_increasing_id()
                           - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    ordered = cut_lineage(ordered)
    counts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    return (ordered.join(offsets, "_pid")
            .withColumn(name, (F.col("_off") + F.col("_local")).cast("long"))
            .drop("_pid", "_local", "_off"))


def rank_in_groups(df: DataFrame, group: list[str], order: list, name: str = "rn",
                   keep_index: bool = False) -> DataFrame:
    """``row_number() over (partition by group order by order)`` (1-based), skew-safe."""
    idx = with_global_index(df, [F.col(g) for g in group] + list(order), "_gidx")
    first = settled(idx.groupBy(*group).agg(F.min("_gidx").alias("_gfirst")))
    out = (join_same(idx, first, group)
           .withColumn(name, (F.col("_gidx") - F.col("_gfirst") + 1).cast("long"))
           .drop("_gfirst"))
    return out if keep_index else out.drop("_gidx")


def neighbour(indexed: DataFrame, group: list[str], cols: list[str], offset: int,
              index: str = "_gidx", prefix: str = "prev_") -> DataFrame:
    """Attach ``cols`` of the row ``offset`` positions earlier in the same group.

    ``offset=1`` is ``lag(1)``, ``offset=-1`` is ``lead(1)``.

    ``indexed`` must carry a global index from :func:`with_global_index` whose order
    starts with ``group``. Missing neighbours give nulls, as lag/lead do.
    """
    other = indexed.select(
        (F.col(index) + F.lit(offset)).alias("_nidx"),
        *[F.col(g).alias("_n_" + g) for g in group],
        *[F.col(c).alias(prefix + c) for c in cols])
    cond = [indexed[index] == other["_nidx"]] + [indexed[g].eqNullSafe(other["_n_" + g]) for g in group]
    return (indexed.join(other, cond, "left")
            .drop("_nidx", *["_n_" + g for g in group]))


def running_sum(df: DataFrame, group: list[str], order: list, value, name: str,
                num_partitions: int | None = None) -> DataFrame:
    """``sum(value) over (partition by group order by order rows unbounded preceding)``, skew-safe."""
    return running_sums(df, group, order, {name: value}, num_partitions)


def running_sums(df: DataFrame, group: list[str], order: list, values: dict,
                 num_partitions: int | None = None) -> DataFrame:
    """Several running sums over the same group and order in one pass, skew-safe.

    Rows are range-partitioned on (group, order), so a hot group spans several
    partitions. Sums run inside each (group, partition) chunk, and each chunk adds
    the totals of the same group's earlier chunks (a table with one row per chunk,
    at most one per partition for any group). ``values`` maps output names to
    columns; a value of ``1`` gives the 1-based position in the group.
    """
    n = num_partitions or shuffle_partitions(df.sparkSession)
    keys = [F.col(g) for g in group] + list(order)
    tmp = {name: f"_v_{i}" for i, name in enumerate(values)}
    staged = df
    for name, v in values.items():
        staged = staged.withColumn(tmp[name], F.col(v) if isinstance(v, str) else
                                   (v if isinstance(v, Column) else F.lit(v)))
    ranged = cut_lineage(staged.repartitionByRange(n, *keys).withColumn("_pid", F.spark_partition_id()))
    w = Window.partitionBy(*group, "_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged
    for name in values:
        local = local.withColumn("_l" + tmp[name], F.sum(tmp[name]).over(w))
    chunks = ranged.groupBy(*group, "_pid").agg(*[F.sum(tmp[nm]).alias("_t" + tmp[nm]) for nm in values])
    wo = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = chunks.select(*group, "_pid", *[F.coalesce(F.sum("_t" + tmp[nm]).over(wo), F.lit(0)).alias("_o" + tmp[nm])
                                           for nm in values])
    out = join_same(local, offs, group + ["_pid"])
    for name in values:
        out = out.withColumn(name, F.col("_o" + tmp[name]) + F.col("_l" + tmp[name]))
    drop = ["_pid"] + [c for nm in values for c in (tmp[nm], "_l" + tmp[nm], "_o" + tmp[nm])]
    return out.drop(*drop)
