"""Shortest paths over an edge table as a graph of predecessors, searched from both ends.

Every level is one job: the frontier joins the edges, new states (an anti join against the side's one written table of states
seen) are written to it with their depth and the number of shortest paths that reach them, and the same job counts
them and those that the other side has seen. The side with the smaller frontier goes on. Where the sides meet, the number of
shortest paths is the sum over the meeting states of both sides' counts; paths are listed only on request, by
walking the written levels.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tessera.operators.ordering import settled
from tessera.session import ensure_checkpoint_dir

STATES = "state string, depth int, n decimal(38,0)"


@dataclass
class Side:
    """One end of the search: states with depth and path count, a folder a level."""

    root: str
    depth: int = 0
    frontier: int = 1
    step: DataFrame | None = field(default=None, repr=False)  # edges (state, next) in this side's direction

    def read(self, spark, level: int | None = None) -> DataFrame:
        return spark.read.schema(STATES).parquet(f"{self.root}/level={'*' if level is None else level}")


@dataclass
class Meeting:
    """Where both sides met: shortest paths are ``ahead`` states at ``ahead.depth`` that ``back`` has at ``back.depth``."""

    ahead: Side
    back: Side
    found: bool
    edges: DataFrame = field(repr=False)


def _put(side: Side, rows: DataFrame) -> None:
    rows.select("state", "depth", F.col("n").cast("decimal(38,0)").alias("n")).write.mode("overwrite").parquet(f"{side.root}/level={side.depth}")


def _expand(spark, side: Side, other: Side) -> int:
    """One level further; returns the number of new states that the other side has seen."""
    at = side.read(spark, side.depth).join(side.step, "state")
    new = at.groupBy(F.col("next").alias("state")).agg(F.sum("n").alias("n")).join(side.read(spark).select("state"), "state", "left_anti")
    seen = other.read(spark, other.depth).select("state", F.lit(1).alias("_met"))
    side.depth += 1
    told = Observation(f"level-{uuid.uuid4().hex}")
    new = new.join(seen, "state", "left").withColumn("depth", F.lit(side.depth)).observe(
        told, F.count(F.lit(1)).alias("states"), F.coalesce(F.sum("_met"), F.lit(0)).alias("met"))
    _put(side, new)
    side.frontier = told.get["states"]
    return told.get["met"]


def search(edges: DataFrame, start: str, goal: str) -> Meeting:
    """Breadth first from both ends until they meet or one has no state left. Rows with a null end are no edges."""
    spark = edges.sparkSession
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/paths-{uuid.uuid4().hex}"
    e = settled(edges.select("src", "dst").where("src is not null and dst is not null").distinct())
    ahead = Side(f"{root}/ahead", step=e.select(F.col("src").alias("state"), F.col("dst").alias("next")))
    back = Side(f"{root}/back", step=e.select(F.col("dst").alias("state"), F.col("src").alias("next")))
    for side, state in ((ahead, start), (back, goal)):
        _put(side, spark.range(1).select(F.lit(state).alias("state"), F.lit(0).alias("depth"), F.lit(1).alias("n")))
    met = int(start == goal)
    while not met and ahead.frontier and back.frontier:
        side, other = (ahead, back) if ahead.frontier <= back.frontier else (back, ahead)
        met = _expand(spark, side, other)
    return Meeting(ahead, back, bool(met), e)


def _meeting_states(m: Meeting, spark) -> DataFrame:
    a, b = m.ahead.read(spark, m.ahead.depth), m.back.read(spark, m.back.depth)
    return a.select("state", F.col("n").alias("a")).join(b.select("state", F.col("n").alias("b")), "state")


def path_counts(edges: DataFrame, start: str, goal: str) -> DataFrame:
    """One row (depth, n_paths decimal): length and number of the shortest paths; no row if the goal is out of reach."""
    spark = edges.sparkSession
    m = search(edges, start, goal)
    if not m.found:
        return spark.range(0).select(F.lit(0).alias("depth"), F.lit(0).cast("decimal(38,0)").alias("n_paths"))
    return _meeting_states(m, spark).agg(F.lit(m.ahead.depth + m.back.depth).alias("depth"), F.sum(F.col("a") * F.col("b")).cast("decimal(38,0)").alias("n_paths"))


def path_search(edges: DataFrame, start: str, goal: str) -> DataFrame:
    """All shortest paths from ``start`` to ``goal``: ``path`` (array) and ``depth``; no row if out of reach.

    The list is as long as ``path_counts`` says; it is built backwards over the levels of one side and forwards over
    those of the other, joins only, without a collect.
    """
    spark = edges.sparkSession
    m = search(edges, start, goal)
    if not m.found:
        return spark.range(0).select(F.array().cast("array<string>").alias("path"), F.lit(0).alias("depth"))
    paths = _meeting_states(m, spark).select(F.array("state").alias("path"), F.col("state").alias("_first"), F.col("state").alias("_last"))
    e = m.edges.select("src", "dst")
    for level in range(m.ahead.depth - 1, -1, -1):
        paths = (paths.join(e, F.col("_first") == F.col("dst")).join(m.ahead.read(spark, level).select(F.col("state").alias("src")), "src")
                 .select(F.concat(F.array("src"), "path").alias("path"), F.col("src").alias("_first"), "_last"))
    for level in range(m.back.depth - 1, -1, -1):
        paths = (paths.join(e, F.col("_last") == F.col("src")).join(m.back.read(spark, level).select(F.col("state").alias("dst")), "dst")
                 .select(F.concat("path", F.array("dst")).alias("path"), F.col("dst").alias("_last")))
    return paths.select("path", F.lit(m.ahead.depth + m.back.depth).alias("depth"))
