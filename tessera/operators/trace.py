"""Agent-trace operators.

A trace is ``run, step, agent, content`` (plus whatever the caller keeps). Step
numbers, previous-step lookups and running counts use the skew-safe helpers of
``ordering``; per-run summaries are partial aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ordering import join_same, neighbour, running_sums, settled


def failed(content) -> Column:
    """The rule that stands in for the LLM verifier: a tool result starting with ``Error:``."""
    return content.startswith("Error:")


def verify_gate(trace: DataFrame, run: str, step: str, content: str) -> DataFrame:
    """V1: steps up to the first failure of each run; the failing step is recorded as
    ``Verification Failed: …`` and the rest of the plan is dropped."""
    fails = settled(trace.where(failed(F.col(content))).groupBy(run).agg(F.min(step).alias("_first_fail")))
    j = join_same(trace, fails, [run], "left")
    return (j.where(F.col("_first_fail").isNull() | (F.col(step) <= F.col("_first_fail")))
            .withColumn("status", F.when(F.col(step) == F.col("_first_fail"),
                                         F.concat(F.lit("Verification Failed: "), F.col(content)))
                        .otherwise(F.lit("passed")))
            .drop("_first_fail"))


def retry_budget(trace: DataFrame, run: str, order: list[str], content: str, max_retries: int = 3) -> DataFrame:
    """V2: running count of failures per run; the run stops (error answer) once it exceeds
    ``max_retries``; steps after the stopping step are dropped. Step numbers and the
    failure count come from one skew-safe running pass over (run, order)."""
    r = running_sums(trace, [run], [F.col(c) for c in order],
                     {"step": F.lit(1).cast("long"), "retries": failed(F.col(content)).cast("long")})
    stop = settled(r.where(F.col("retries") > max_retries).groupBy(run).agg(F.min("step").alias("_stop")))
    return (join_same(r, stop, [run], "left")
            .where(F.col("_stop").isNull() | (F.col("step") <= F.col("_stop")))
            .withColumn("action", F.when(F.col("step") == F.col("_stop"), F.lit("stop")).otherwise(F.lit("continue")))
            .drop("_stop"))


def loop_stats(trace: DataFrame, run: str, tool_call: Column, limits=(10, 15)) -> DataFrame:
    """V3: steps, tool calls and loops (repeated tool calls) per run; flags for step limits.
    One partial aggregate; steps are counted, so no step numbering is needed."""
    g = trace.groupBy(run).agg(F.count(F.lit(1)).alias("steps"),
                               F.sum(tool_call.cast("long")).alias("tool_calls"))
    out = g.withColumn("last_step", F.col("steps")).withColumn("loops", F.greatest(F.col("tool_calls") - 1, F.lit(0)))
    for lim in limits:
        out = out.withColumn(f"at_limit_{lim}", F.col("steps") >= lim)
    return out


def latest_state(trace: DataFrame, run: str, order: list[str], cols: list[str]) -> DataFrame:
    """V4: the last snapshot of each run by ``order`` (``max_by`` = partial aggregate);
    ``step`` is its 1-based position, i.e. the number of snapshots."""
    st = F.struct(*[F.col(c) for c in cols])
    return (trace.groupBy(run).agg(F.max_by(st, F.struct(*[F.col(c) for c in order])).alias("_s"),
                                   F.count(F.lit(1)).alias("step"))
            .select(run, "step", *[F.col("_s")[c].alias(c) for c in cols]))


def agent_transitions(indexed: DataFrame, run: str, agent: str) -> DataFrame:
    """Which agent ran after which, counted. ``indexed`` carries ``_gidx`` ordered
    by (run, step); the previous step is an equi join on the unique index."""
    j = neighbour(indexed, [run], [agent], 1, prefix="prev_")
    return (j.where(F.col("prev_" + agent).isNotNull())
            .groupBy(F.col("prev_" + agent).alias("from_agent"), F.col(agent).alias("to_agent"))
            .agg(F.count(F.lit(1)).alias("n")))


def trace_render(trace: DataFrame, run: list[str], order: list[str], type_col: str, content: str,
                 tool_calls: Column) -> DataFrame:
    """Message history as text, ``type: content tool_calls`` per line, in ``order``.

    The history string is the output itself, so one run is gathered into one row;
    lines are built before the shuffle so only strings travel. A run is one agent
    session (bounded by the step limit), not a user's whole lifetime.
    """
    line = F.concat_ws(" ", F.concat(F.col(type_col), F.lit(": "), F.col(content)), tool_calls)
    key = F.struct(*[F.col(c) for c in order]).alias("s")
    return (trace.select(*run, F.struct(key, line.alias("l")).alias("_sl"))
            .groupBy(*run).agg(F.array_join(F.transform(F.array_sort(F.collect_list("_sl")), lambda x: x["l"]), "\n")
                               .alias("history")))


def merge_reports(reports: DataFrame, request: list[str], persona: str, order: str, text: str,
                  personas: list[str], missing: str = "(no report)") -> DataFrame:
    """One row per request; each persona's first report under a fixed heading.

    ``pivot`` with the persona list given, so no extra job and absent personas stay null.
    """
    p = (reports.groupBy(*request).pivot(persona, personas)
         .agg(F.min_by(F.col(text), F.col(order))))
    parts = [F.concat(F.lit(f"## {name}\n"), F.coalesce(F.col(name), F.lit(missing))) for name in personas]
    return p.select(*request, F.concat_ws("\n\n", *parts).alias("merged"))


def blackboard(posts: DataFrame, run: list[str], order: list[str], author: str, text: str) -> DataFrame:
    """Signed posts; at step n the specialist sees posts 1..n-1 joined by ``\\n---\\n``.

    The visible board is the output itself (it grows with the run); runs are bounded
    by the agent step limit, so the frame per run is small.
    """
    signed = F.concat(F.lit("**Report from "), F.col(author), F.lit(":**\n"), F.col(text))
    w = Window.partitionBy(*run).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (posts.withColumn("post", signed)
            .withColumn("board", F.array_join(F.collect_list("post").over(w), "\n---\n")))


def before_after(scores: DataFrame, key: list[str], phase: str, score: str, before: str = "draft",
                 after: str = "refined") -> DataFrame:
    """The same judge on draft and refined output, compared per key (conditional aggregation)."""
    g = scores.groupBy(*key).agg(F.avg(F.when(F.col(phase) == before, F.col(score))).alias("before"),
                                 F.avg(F.when(F.col(phase) == after, F.col(score))).alias("after"))
    return g.withColumn("delta", F.col("after") - F.col("before"))


def attach_results(steps: DataFrame, results: DataFrame, query: str) -> DataFrame:
    """Plan step <-> its tool result by a stable id derived from the query text (md5)."""
    s = steps.withColumn("result_id", F.md5(F.col(query)))
    return s.join(results, "result_id", "left")


def judge_scores(df: DataFrame, system: str, dimension: str, score: str) -> DataFrame:
    """Mean / min / max score per system and dimension."""
    return df.groupBy(system, dimension).agg(F.avg(score).alias("mean_score"), F.min(score).alias("min_score"),
                                             F.max(score).alias("max_score"), F.count(F.lit(1)).alias("n"))
