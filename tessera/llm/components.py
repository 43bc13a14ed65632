"""Connected components of an edge table by repeated contraction.

Every round maps each node to the smallest node of its closed neighbourhood and rewrites the
edges between the images; the images are the nodes of the next round. Rounds alternate between
the order of the ids (a star around its smallest node vanishes at once) and a seeded random order
(any other shape, long chains included, loses a constant share of its nodes), so the number of
rounds is logarithmic. The minimum is a partial aggregate and the rewriting joins read written
tables, so a hub with many neighbours never sits in one task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tessera.llm.workspace import Workspace


def connected_components(edges: DataFrame, ws: Workspace, name: str = "cc") -> DataFrame:
    """(a long, b long) -> (node, root): a row per node that has an edge to another node.

    Nodes of one component share ``root`` (one of its nodes). Rows with a null end, loops and
    repeated or reversed edges add nothing. An empty edge table gives an empty result.
    """
    e = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")) \
        .filter("a is not null and b is not null and a <> b")
    maps, k = [], 0
    e = ws.put(e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-e0")
    while not e.isEmpty():
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = (lambda c: F.col(c)) if k % 2 == 0 else (lambda c: F.xxhash64(F.col(c), F.lit(k)))  # noqa: B023
        low = (both.groupBy(F.col("a").alias("node"))
               .agg(F.min(F.struct(rank("b").alias("r"), F.col("b").alias("to"))).alias("m")))
        low = low.select("node", F.when(F.struct(rank("node").alias("r"), F.col("node").alias("to")) < F.col("m"),
                                        F.col("node")).otherwise(F.col("m.to")).alias("to"))
        low = ws.put(low, f"{name}-m{k}")
        maps.append(low)
        left = e.join(low.withColumnsRenamed({"node": "a", "to": "ta"}), "a")
        both_ends = left.join(low.withColumnsRenamed({"node": "b", "to": "tb"}), "b").filter("ta <> tb")
        e = ws.put(both_ends.select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(),
                   f"{name}-e{k + 1}")
        k += 1
    if not maps:
        return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = maps[0].withColumnRenamed("to", "root")
    for low in maps[1:]:
        out = (out.join(low.withColumnsRenamed({"node": "root", "to": "next"}), "root", "left")
               .select("node", F.coalesce("next", "root").alias("root")))
    return ws.put(out, f"{name}-out")


def smallest_linked(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Within one task: the smallest of 0..n-1 that each reaches over the pairs (i, j)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label, new)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new
