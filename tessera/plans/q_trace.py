"""Agent-trace queries on ``events`` (fixture F5): run = user, agent = event type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.numeric import r6

from tessera.operators import trace as tr
from tessera.operators.ordering import rank_in_groups, with_global_index
from tessera.plans.q_text import K_SQL, STEP_SQL, TOOL_RE, _k, plan_steps
from tessera.operators.text import parse_tool_call
from tessera.plans.registry import register
from tessera.sources.tables import table

PERSONAS = ["view", "click", "signup", "purchase", "error"]


def content_col():
    et = F.col("event_type")
    return (F.when(et == "error", F.concat(F.lit("Error: "), et, F.lit(" "), _k()))
            .otherwise(F.concat(F.lit("Result: "), et, F.lit(" "), _k())))


def events_trace(spark, sf) -> DataFrame:
    """Trace rows without step numbers (for per-run summaries that only need counts)."""
    e = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    return e.withColumn("content", content_col())


def indexed_trace(spark, sf) -> DataFrame:
    """Trace rows with the global position ``_gidx`` in (user, ts, event_id) order - enough
    for previous/next-step joins, without per-run step numbers."""
    e = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    return with_global_index(e, [F.col("user_id"), F.col("ts"), F.col("event_id")], "_gidx")


def trace(spark, sf, keep_index: bool = False) -> DataFrame:
    return rank_in_groups(events_trace(spark, sf), ["user_id"], [F.col("ts"), F.col("event_id")], "step", keep_index)


CONTENT_SQL = f"(CASE WHEN event_type = 'error' THEN 'Error: ' ELSE 'Result: ' END || event_type || ' ' || {K_SQL})"
TRACE_SQL = f"""
WITH t AS (SELECT event_id, ts, user_id, event_type, value, props, {CONTENT_SQL} AS content,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step FROM events)
"""


@register("v1_verify_gate", TRACE_SQL + """,
f AS (SELECT user_id, min(step) AS ff FROM t WHERE starts_with(content, 'Error:') GROUP BY user_id)
SELECT t.user_id, t.step, CASE WHEN t.step = f.ff THEN 'Verification Failed: ' || t.content ELSE 'passed' END AS status
FROM t LEFT JOIN f USING (user_id) WHERE f.ff IS NULL OR t.step <= f.ff
""")
def v1(spark, sf):
    return tr.verify_gate(trace(spark, sf), "user_id", "step", "content").select("user_id", "step", "status")


@register("v2_retry_budget", TRACE_SQL + """,
r AS (SELECT user_id, step, sum(CASE WHEN starts_with(content, 'Error:') THEN 1 ELSE 0 END)
                               OVER (PARTITION BY user_id ORDER BY step) AS retries FROM t),
s AS (SELECT user_id, min(step) AS st FROM r WHERE retries > 3 GROUP BY user_id)
SELECT r.user_id, r.step, CAST(r.retries AS BIGINT) AS retries, CASE WHEN r.step = s.st THEN 'stop' ELSE 'continue' END AS action
FROM r LEFT JOIN s USING (user_id) WHERE s.st IS NULL OR r.step <= s.st
""")
def v2(spark, sf):
    return tr.retry_budget(events_trace(spark, sf), "user_id", ["ts", "event_id"], "content", 3).select(
        "user_id", "step", "retries", "action")


@register("v3_loop_stats", TRACE_SQL + """
SELECT user_id, count(*) AS steps, CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS tool_calls,
       max(step) AS last_step, CAST(greatest(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) - 1, 0) AS BIGINT) AS loops,
       count(*) >= 10 AS at_limit_10, count(*) >= 15 AS at_limit_15
FROM t GROUP BY user_id
""")
def v3(spark, sf):
    return tr.loop_stats(events_trace(spark, sf), "user_id", F.col("event_type") == "click")


@register("v4_latest_state", TRACE_SQL + """
SELECT user_id, step, event_type, content FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY step DESC) AS rn FROM t) WHERE rn = 1
""")
def v4(spark, sf):
    return tr.latest_state(events_trace(spark, sf), "user_id", ["ts", "event_id"], ["event_type", "content"])


@register("w10_agent_transitions", TRACE_SQL + """
SELECT prev AS from_agent, event_type AS to_agent, count(*) AS n
FROM (SELECT event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY step) AS prev FROM t) WHERE prev IS NOT NULL
GROUP BY prev, event_type
""")
def w10(spark, sf):
    return tr.agent_transitions(indexed_trace(spark, sf), "user_id", "event_type")


@register("c8_trace_render", f"""
SELECT user_id, CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS day,
       string_agg(event_type || ': ' || {CONTENT_SQL} || CASE WHEN event_type = 'click' THEN ' [tool:web_search]' ELSE '' END,
                  chr(10) ORDER BY ts, event_id) AS history
FROM events GROUP BY user_id, day
""")
def c8(spark, sf):
    """Run = one user's session of a day (as for C10)."""
    t = events_trace(spark, sf).withColumn("day", F.unix_date(F.to_date("ts")))
    calls = F.when(F.col("event_type") == "click", F.lit("[tool:web_search]"))
    return tr.trace_render(t, ["user_id", "day"], ["ts", "event_id"], "event_type", "content", calls)


@register("c9_merge_reports", f"""
WITH r AS (SELECT user_id, CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS day, event_type, event_id, event_type || ' report ' || {K_SQL} AS report FROM events),
f AS (SELECT user_id, day, event_type, arg_min(report, event_id) AS report FROM r GROUP BY ALL),
p AS (SELECT user_id, day, {", ".join(f"max(CASE WHEN event_type = '{x}' THEN report END) AS r_{x}" for x in PERSONAS)} FROM f GROUP BY user_id, day)
SELECT user_id, day, concat_ws(chr(10) || chr(10), {", ".join(f"'## {x}' || chr(10) || coalesce(r_{x}, '(no report)')" for x in PERSONAS)}) AS merged FROM p
""")
def c9(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "props")
    r = e.select("user_id", F.unix_date(F.to_date("ts")).alias("day"), "event_type", "event_id",
                 F.concat(F.col("event_type"), F.lit(" report "), _k()).alias("report"))
    return tr.merge_reports(r, ["user_id", "day"], "event_type", "event_id", "report", PERSONAS)


@register("c10_blackboard", f"""
WITH p AS (SELECT user_id, CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS day, ts, event_id,
                  '**Report from ' || event_type || ':**' || chr(10) || {CONTENT_SQL} AS post FROM events)
SELECT user_id, day, event_id, post,
       coalesce(string_agg(post, chr(10) || '---' || chr(10)) OVER (PARTITION BY user_id, day ORDER BY ts, event_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS board FROM p
""")
def c10(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "props")
    e = e.select("user_id", F.unix_date(F.to_date("ts")).alias("day"), "ts", "event_id", "event_type",
                 content_col().alias("content"))
    b = tr.blackboard(e, ["user_id", "day"], ["ts", "event_id"], "event_type", "content")
    return b.select("user_id", "day", "event_id", "post", "board")


SCORE = "least(10, 1 + floor(value / 10))"


def judged(spark, sf) -> DataFrame:
    e = table(spark, sf, "events").select("ts", "user_id", "event_type", "value")
    return e.select((F.col("user_id") % 2).alias("system"), F.col("event_type").alias("dimension"),
                    F.least(F.lit(10), 1 + F.floor(F.col("value") / 10)).cast("long").alias("score"),
                    F.when(F.dayofmonth("ts") <= 15, "draft").otherwise("refined").alias("phase"))


@register("g12_judge_scores", f"""
SELECT user_id % 2 AS system, event_type AS dimension, round(avg(CAST({SCORE} AS BIGINT)), 6) AS mean_score,
       CAST(min({SCORE}) AS BIGINT) AS min_score, CAST(max({SCORE}) AS BIGINT) AS max_score, count(*) AS n
FROM events GROUP BY ALL
""")
def g12(spark, sf):
    g = tr.judge_scores(judged(spark, sf), "system", "dimension", "score")
    return g.withColumn("mean_score", r6("mean_score", 6))


@register("j4_before_after", f"""
WITH s AS (SELECT user_id % 2 AS system, event_type AS dimension, CAST({SCORE} AS BIGINT) AS score,
                  CASE WHEN dayofmonth(ts) <= 15 THEN 'draft' ELSE 'refined' END AS phase FROM events),
g AS (SELECT system, dimension, avg(CASE WHEN phase = 'draft' THEN score END) AS b, avg(CASE WHEN phase = 'refined' THEN score END) AS a
      FROM s GROUP BY ALL)
SELECT system, dimension, round(b, 6) AS before, round(a, 6) AS after, round(a - b, 6) AS delta FROM g
""")
def j4(spark, sf):
    g = tr.before_after(judged(spark, sf), ["system", "dimension"], "phase", "score")
    return g.select("system", "dimension", *[r6(c, 6).alias(c) for c in ("before", "after", "delta")])


@register("j5_attach_results", f"""
WITH s AS (SELECT event_id, {STEP_SQL} AS step FROM events),
p AS (SELECT event_id,
        CASE WHEN regexp_matches(step, '{TOOL_RE}') THEN regexp_extract(step, '{TOOL_RE}', 1) ELSE 'web_search' END AS tool,
        CASE WHEN regexp_matches(step, '{TOOL_RE}') THEN regexp_extract(step, '{TOOL_RE}', 2) ELSE step END AS query FROM s),
r AS (SELECT md5(event_type || ' ' || {K_SQL}) AS result_id, 'hits=' || CAST(count(*) AS VARCHAR) AS result FROM events GROUP BY 1)
SELECT p.event_id, p.tool, p.query, md5(p.query) AS result_id, r.result FROM p LEFT JOIN r ON r.result_id = md5(p.query)
""")
def j5(spark, sf):
    steps = parse_tool_call(plan_steps(spark, sf), "step").select("event_id", "tool", "query")
    e = table(spark, sf, "events").select("event_type", "props")
    results = (e.groupBy(F.md5(F.concat(F.col("event_type"), F.lit(" "), _k())).alias("result_id"))
               .agg(F.concat(F.lit("hits="), F.count(F.lit(1)).cast("string")).alias("result")))
    return tr.attach_results(steps, results, "query").select("event_id", "tool", "query", "result_id", "result")
