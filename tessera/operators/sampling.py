"""W3 for any n: rows by a cut value of their hash, never a ``limit`` in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ordering import md5_order, with_global_index

DIGITS = 4  # hex digits of a histogram's key: at most 65,536 rows


def sample_n(df: DataFrame, id_col: str, n: int, seed: str = "42") -> DataFrame:
    """The n rows with the smallest (md5 of id||seed, id); all rows when there are fewer.

    A histogram over the first hex digits of the hash gives the prefix in which the n-th row lies: rows with a smaller prefix
    are in, and only those of that prefix (one in 65,536) are put in order, over range partitions, for the rest. Rows without an
    id come first; among rows with one id any may be taken.
    """
    if n <= 0:
        return df.limit(0)
    hashed = df.withColumn("_shuf", md5_order(id_col, seed)).withColumn("_bin", F.coalesce(F.substring("_shuf", 1, DIGITS), F.lit("")))
    bins = hashed.groupBy("_bin").agg(F.count(F.lit(1)).alias("_n"))
    total = bins.withColumn("_to", F.sum("_n").over(Window.orderBy("_bin")))  # at most 65,537 rows, whatever the table
    cut = total.where(F.col("_to") >= n).agg(F.min(F.struct("_bin", "_to", "_n")).alias("c")).select("c.*").first()
    if cut["_bin"] is None:
        return df
    inside = hashed.where(F.col("_bin") < F.lit(cut["_bin"])).select(*df.columns)
    missing = n - (cut["_to"] - cut["_n"])
    edge = with_global_index(hashed.where(F.col("_bin") == F.lit(cut["_bin"])), [F.col("_shuf"), F.col(id_col)], "_place")
    return inside.unionByName(edge.where(F.col("_place") < missing).select(*df.columns))
