"""Exact k nearest neighbours over pivot cells.

Some vectors of the corpus are pivots (the smallest MD5s of their ids; their number is a parameter and bounds what tasks
are handed). Every vector lies in the cell of its nearest pivot and is stored with its distance to it, in blocks of
at most ``BLOCK`` vectors, cut in the order of that distance, that know the least and greatest of theirs. For a query at distance d of a
pivot, the triangle inequality puts every vector of a block at least max(d - greatest, least - d) away, and for
pivots p and r the side of the plane between them puts every vector of p's cell at least
(d(q, p)^2 - d(q, r)^2) / (2 d(p, r)) away. A first visit, to one block of the query's own cell, bounds its k-th
distance; a second one goes to the cells whose bound does not pass it, and inside a cell only to blocks and vectors that
may lie nearer. Nothing is left out by a guess: bounds are compared with some slack for rounding.

Two blocks are compared by one matrix product, |q|^2 + |x|^2 - 2 qx. Its rounding error is bounded, so it only tells which
pairs may be among the k nearest; the distances that are ranked and returned are computed from the differences. A
block of queries keeps its k nearest while it goes through the blocks of a cell, and each one lowers the bound for the next.

How much is spared depends on the data: clustered vectors visit few cells, vectors spread evenly over a sphere
visit all (``visited_share`` measures it), and the result is the same: all pairs are then compared, in memory that does
not grow, shared out by cell and query block.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ordering import settled

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need numpy and pandas, not this package

PIVOTS = 16
BLOCK = 4096
BLOCK_BYTES = 2 << 20  # blocks of wide vectors have fewer rows
SHARES = 8  # tasks that share the queries of a cell
SLACK = 1e-9

BLOCKS = "cell int, least double, most double, ids array<bigint>, groups array<bigint>, dists array<double>, vectors array<double>"


def usable(vec: Column) -> Column:
    """Not null and finite in every component."""
    return vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def pivot_matrix(corpus: DataFrame, pivots: int) -> np.ndarray:
    """At most ``pivots`` distinct vectors of the corpus."""
    rows = corpus.orderBy(F.md5(F.col("id").cast("string")), "id").limit(pivots).select("v").collect()
    return np.unique(np.array([r["v"] for r in rows], float), axis=0) if rows else np.empty((0, 0))


def to_pivots(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(((x[:, None, :] - pivots[None, :, :]) ** 2).sum(axis=2))


def fitting(block: int, width: int) -> int:
    return max(1, min(block, BLOCK_BYTES // (8 * max(width, 1))))


def in_cells(rows: DataFrame, pivots: np.ndarray, block: int) -> DataFrame:
    """Blocks of (id, grp, v): neighbours of one cell by their distance to its pivot, at most ``block`` vectors each."""

    def near(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                x = np.stack(f["v"].to_numpy()).astype(float)
                d = np.concatenate([to_pivots(x[k:k + 256], pivots) for k in range(0, len(x), 256)])
                yield f.assign(cell=d.argmin(axis=1).astype("int32"), dist=d.min(axis=1))

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if not len(f):
                continue
            x = np.stack(f["v"].to_numpy()).astype(float)
            cell, dist, ids, groups = (f[c].to_numpy() for c in ("cell", "dist", "id", "grp"))
            out, most = [], fitting(block, x.shape[1])
            for run_ in np.split(np.arange(len(f)), np.flatnonzero(np.diff(cell)) + 1):
                for k in range(0, len(run_), most):
                    own = run_[k:k + most]
                    out.append((int(cell[own[0]]), dist[own[0]], dist[own[-1]], ids[own], groups[own], dist[own], x[own].reshape(-1)))
            yield pd.DataFrame(out, columns=["cell", "least", "most", "ids", "groups", "dists", "vectors"])

    placed = settled(rows.mapInPandas(near, "id long, grp long, v array<double>, cell int, dist double"))
    order = ["cell", "dist", "id"]
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(cut, BLOCKS)


def met(asked: DataFrame, blocks: DataFrame) -> DataFrame:
    """Query blocks with every block of their cell; a cell's query blocks are shared out over tasks."""
    share = F.pmod(F.xxhash64(F.col("qids")[0]), F.lit(SHARES)).cast("int")
    return asked.withColumn("share", share).join(blocks.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1)))), ["cell", "share"])


class Nearest:
    """The k nearest vectors that a block of queries has met so far; its bounds fall with every block."""

    def __init__(self, ids: np.ndarray, groups: np.ndarray, at: np.ndarray, reach: np.ndarray, q: np.ndarray, k: int):
        self.ids, self.groups, self.at, self.q, self.k = ids, groups, at, q, k
        self.reach = reach * (1 + SLACK) + SLACK
        self.squares = (q ** 2).sum(axis=1)
        self.best = np.full((len(ids), k), np.inf)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)

    def meet(self, least: float, most: float, ids: np.ndarray, groups: np.ndarray, dists: np.ndarray, x: np.ndarray) -> None:
        squares = (x ** 2).sum(axis=1)
        for b in range(0, len(self.ids), 256):
            rows = np.arange(b, min(b + 256, len(self.ids)))
            reach = np.minimum(self.reach[rows], np.sqrt(self.best[rows, -1]) * (1 + SLACK) + SLACK)
            on = np.maximum(self.at[rows] - most, least - self.at[rows]) <= reach
            rows, reach = rows[on], reach[on]
            if not len(rows):
                continue
            low = np.searchsorted(dists, (self.at[rows] - reach).min())
            high = np.searchsorted(dists, (self.at[rows] + reach).max(), side="right")
            for c in range(low, high, 1024):
                some = slice(c, min(c + 1024, high))
                self._compare(rows, ids[some], groups[some], x[some], squares[some])

    def _compare(self, rows: np.ndarray, ids: np.ndarray, groups: np.ndarray, x: np.ndarray, squares: np.ndarray) -> None:
        q, own = self.q[rows], self.squares[rows]
        error = 4 * (q.shape[1] + 8) * np.finfo(float).eps * (own.max() + squares.max())
        d2 = q @ x.T
        d2 *= -2
        d2 += own[:, None]
        d2 += squares[None, :]
        kth, last = self.best[rows, -1], self.found[rows, -1]
        may = d2 <= (np.minimum(self.reach[rows] ** 2, kth) + error)[:, None]
        if np.count_nonzero(may) > 4 * self.k * len(rows) and len(ids) > self.k:  # by the k-th of these vectors
            d2[self.groups[rows][:, None] == groups[None, :]] = np.inf
            may &= d2 <= (np.partition(d2, self.k - 1, axis=1)[:, self.k - 1] + 2 * error)[:, None]
        i, j = np.nonzero(may)
        keep = (self.groups[rows][i] != groups[j]) & ((kth[i] > 0) | (ids[j] < last[i]))  # nothing is nearer than 0
        i, j = i[keep], j[keep]
        if not len(i):
            return
        exact = np.concatenate([((q[i[s:s + 16384]] - x[j[s:s + 16384]]) ** 2).sum(axis=1) for s in range(0, len(i), 16384)])
        better = (exact < kth[i]) | ((exact == kth[i]) & (ids[j] < last[i]))
        i, found, exact = i[better], ids[j[better]], exact[better]
        some = np.unique(i)
        i = np.concatenate([i, np.repeat(some, self.k)])
        exact = np.concatenate([exact, self.best[rows[some]].reshape(-1)])
        found = np.concatenate([found, self.found[rows[some]].reshape(-1)])
        order = np.lexsort((found, exact, i))
        i = i[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        top = rank < self.k
        self.best[rows[i[top]], rank[top]] = exact[order][top]
        self.found[rows[i[top]], rank[top]] = found[order][top]

    def rows(self) -> pd.DataFrame:
        i, j = np.nonzero(np.isfinite(self.best))
        return pd.DataFrame({"qid": self.ids[i], "cid": self.found[i, j], "dist": self.best[i, j]})


def compared(pairs: DataFrame, k: int) -> DataFrame:
    """(qids, qgroups, qvectors, reach, block columns) -> the k nearest of each query in blocks that come one after the
    other: (qid, cid, dist)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for f in frames:
            for r in f.itertuples(index=False):
                qids = np.asarray(r.qids)
                if held is None or not np.array_equal(held.ids, qids):
                    if held is not None:
                        yield held.rows()
                    held = Nearest(qids, np.asarray(r.qgroups), np.asarray(r.qdists), np.asarray(r.reach), np.asarray(r.qvectors).reshape(len(qids), -1), k)
                held.meet(r.least, r.most, np.asarray(r.ids), np.asarray(r.groups), np.asarray(r.dists), np.asarray(r.vectors).reshape(len(r.ids), -1))
        if held is not None:
            yield held.rows()

    return pairs.select("qids", "qgroups", "qdists", "reach", "qvectors", "least", "most", "ids", "groups", "dists", "vectors") \
        .mapInPandas(run, "qid long, cid long, dist double")


def bound_to_cells(d: np.ndarray, between: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Lower bound of the distance to any vector of each cell; ``d``: queries x pivots."""
    low = np.maximum(d - most, least - d)
    for p in range(d.shape[1]):
        gap = (d[:, [p]] ** 2 - d ** 2) / (2 * between[p])
        low[:, p] = np.maximum(low[:, p], gap.max(axis=1))
    return low


def visits(queries: DataFrame, reach: DataFrame, cells: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Query blocks with the cells they must visit: (cell, qids, qgroups, qdists, reach, qvectors)."""
    bounds = {r["cell"]: (r["least"], r["most"]) for r in
              cells.groupBy("cell").agg(F.min("least").alias("least"), F.max("most").alias("most")).collect()}  # a row per pivot at most
    least = np.array([bounds.get(c, (np.inf, -np.inf))[0] for c in range(len(pivots))])
    most = np.array([bounds.get(c, (np.inf, -np.inf))[1] for c in range(len(pivots))])
    between = to_pivots(pivots, pivots)
    np.fill_diagonal(between, np.inf)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if not len(f):
                continue
            x = np.stack(f["v"].to_numpy()).astype(float)
            own = f["reach"].fillna(np.inf).to_numpy()
            d = np.concatenate([to_pivots(x[k:k + 256], pivots) for k in range(0, len(x), 256)])
            go = bound_to_cells(d, between, least, most) <= (own * (1 + SLACK) + SLACK)[:, None]
            out, most_rows = [], fitting(BLOCK, x.shape[1])
            for c in np.flatnonzero(np.isfinite(least)):
                rows = np.flatnonzero(go[:, c])
                rows = rows[np.argsort(d[rows, c], kind="stable")]
                for k in range(0, len(rows), most_rows):
                    w = rows[k:k + most_rows]
                    out.append((int(c), f["id"].to_numpy()[w], f["grp"].to_numpy()[w], d[w, c], own[w], x[w].reshape(-1)))
            yield pd.DataFrame(out, columns=["cell", "qids", "qgroups", "qdists", "reach", "qvectors"])

    return queries.join(reach, "id", "left").select("id", "grp", "v", "reach").mapInPandas(
        run, "cell int, qids array<bigint>, qgroups array<bigint>, qdists array<double>, reach array<double>, qvectors array<double>")


def plan_visits(queries: DataFrame, corpus: DataFrame, k: int, pivots: int, block: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(visits, corpus blocks, query rows) of an exact search; see the module's text."""
    matrix = pivot_matrix(corpus, pivots)
    cells = settled(in_cells(corpus, matrix, block))
    asked = settled(in_cells(queries, matrix, block)).select(
        "cell", F.col("ids").alias("qids"), F.col("groups").alias("qgroups"), F.col("dists").alias("qdists"), F.col("vectors").alias("qvectors"),
        F.transform("dists", lambda _: F.lit(float("inf"))).alias("reach"))
    first = cells.groupBy("cell").agg(F.max_by(F.struct("least", "most", "ids", "groups", "dists", "vectors"), F.struct(F.size("ids"), F.col("ids")[0])).alias("b")) \
        .select("cell", "b.*")
    seen = compared(met(asked, first), k).groupBy("qid").agg(F.array_sort(F.collect_list("dist")).alias("d"))  # at most k a query
    reach = settled(seen.select(F.col("qid").alias("id"), F.when(F.size("d") >= k, F.sqrt(F.col("d")[k - 1])).otherwise(F.lit(float("inf"))).alias("reach")))
    return visits(queries, reach, cells, matrix), cells, queries


def prepared(df: DataFrame, id_col: str, vec: str, group: str | None) -> DataFrame:
    v = F.transform(F.col(vec), lambda x: x.cast("double"))
    return settled(df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(group or id_col).cast("long"), -1 - F.col(id_col)).alias("grp"), v.alias("v"))
                   .where(F.col("id").isNotNull() & usable(F.col("v"))))


def knn_join(queries: DataFrame, corpus: DataFrame, q_id: str, c_id: str, vec: str, k: int, group: str | None = None,
             pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """Exact k nearest corpus vectors (squared L2) per query, ties by corpus id: ``query_id, rank, neighbor_id, dist``.

    A query's own group is left out: rows with the same ``group`` (0 or more; null: a group of its own; by default the
    id). Ids are unique integers from 0 on either side; rows with a null id, a null vector or one with null or non-finite
    components take no part.
    """
    q, c = prepared(queries, q_id, vec, group), prepared(corpus, c_id, vec, group)
    if c.isEmpty():
        return c.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("neighbor_id"), F.lit(0.0).alias("dist"))
    going, cells, _ = plan_visits(q, c, k, pivots, block)
    found = compared(met(going, cells), k)
    w = Window.partitionBy("qid").orderBy("dist", "cid")
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select(F.col("qid").alias("query_id"), "rank", F.col("cid").alias("neighbor_id"), "dist"))


def visited_share(queries: DataFrame, corpus: DataFrame, q_id: str, c_id: str, vec: str, k: int, pivots: int = PIVOTS) -> DataFrame:
    """One row (visited, possible): pairs of a query and a cell that the search goes to, and all such pairs."""
    q, c = prepared(queries, q_id, vec, None), prepared(corpus, c_id, vec, None)
    going, cells, _ = plan_visits(q, c, k, pivots, BLOCK)
    visited = going.agg(F.coalesce(F.sum(F.size("qids")), F.lit(0)).cast("long").alias("visited"))
    n_cells = cells.agg(F.count_distinct("cell").alias("cells"))
    return visited.withColumn("possible", q.agg(F.count(F.lit(1)).alias("n")).scalar() * n_cells.scalar())
