"""Streaming queries: the fixture rows are written to a source folder, a stream with
``Trigger.AvailableNow`` processes them into a file sink, and the sink is read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.plans.q_chat import VARIANTS_SQL, conversations
from tessera.plans.q_trace import CONTENT_SQL, content_col
from tessera.plans.registry import register
from tessera.plans.sqlkit import strip
from tessera.sources import files
from tessera.sources.tables import table
from tessera.streaming import prepare as st

BASE_SCHEMA = T.StructType([
    T.StructField("base_id", T.LongType()), T.StructField("ts", T.TimestampType()),
    T.StructField("instruction", T.StringType()), T.StructField("output", T.StringType()),
    T.StructField("paraphrases", T.ArrayType(T.StringType()))])
TRACE_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("event_id", T.LongType()), T.StructField("content", T.StringType())])


def base_rows(spark, sf) -> DataFrame:
    """Stored teacher output per dialog: question, answer and paraphrases (its user turns)."""
    t = conversations(spark, sf)
    users = (t.where(F.col("role") == "user").groupBy("conv_id")
             .agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("_u")))
    answers = t.where(F.col("role") == "assistant").groupBy("conv_id").agg(F.min_by("text", "turn").alias("output"))
    return (users.join(answers, "conv_id", "left")
            .select(F.col("conv_id").alias("base_id"),
                    F.timestamp_seconds(F.lit(1704067200) + F.col("conv_id")).alias("ts"),
                    F.element_at("_u", 1)["text"].alias("instruction"), "output",
                    F.transform("_u", lambda x: x["text"]).alias("paraphrases")))


def _prepared_stream(spark, sf):
    src = files.scratch_dir(spark, "k-src")
    base_rows(spark, sf).write.mode("overwrite").json(src)
    return st.prepare_stream(st.read_stream(spark, src, BASE_SCHEMA))


K1_SQL = "WITH " + VARIANTS_SQL + f""",
k1 AS (SELECT base_id, pos, question, {strip('answer')} AS answer FROM expanded
       WHERE answer IS NOT NULL AND length({strip('answer')}) > 0)
"""


@register("k1_stream_prepare", K1_SQL + " SELECT base_id, pos, question, answer FROM k1")
def k1(spark, sf):
    out, ck = files.scratch_dir(spark, "k1-out"), files.scratch_dir(spark, "k1-ckpt")
    st.run_available_now(_prepared_stream(spark, sf), out, ck)
    schema = "base_id bigint, pos int, ts timestamp, question string, answer string"
    return spark.read.schema(schema).json(out).select("base_id", "pos", "question", "answer")


@register("k2_stream_dedup", K1_SQL + """
SELECT question, base_id, pos FROM k1 QUALIFY row_number() OVER (PARTITION BY question ORDER BY base_id, pos) = 1
""")
def k2(spark, sf):
    """The rows come in eight files, a file a micro-batch, dealt by a hash: most keys repeat in later batches."""
    src, out, ck = (files.scratch_dir(spark, n) for n in ("k2-src", "k2-out", "k2-ckpt"))
    base_rows(spark, sf).repartition(8, F.md5(F.col("base_id").cast("string"))).write.mode("overwrite").json(src)
    rows = st.prepare_stream(st.read_stream(spark, src, BASE_SCHEMA, files_a_batch=1)).select("question", "base_id", "pos")
    st.dedup_batches(rows, out, ck, "question", ["base_id", "pos"])
    return st.settled_first(spark, out, rows.schema, ["base_id", "pos"])


@register("k3_stream_retry_state", f"""
WITH t AS (SELECT user_id, {CONTENT_SQL} AS content,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step FROM events),
r AS (SELECT user_id, step, sum(CASE WHEN starts_with(content, 'Error:') THEN 1 ELSE 0 END)
                               OVER (PARTITION BY user_id ORDER BY step) AS retries FROM t),
s AS (SELECT user_id, min(step) AS st FROM r WHERE retries > 3 GROUP BY user_id)
SELECT r.user_id, r.step, CAST(r.retries AS BIGINT) AS retries, CASE WHEN r.step = s.st THEN 'stop' ELSE 'continue' END AS action
FROM r LEFT JOIN s USING (user_id) WHERE s.st IS NULL OR r.step <= s.st
""")
def k3(spark, sf):
    """The rows come in shuffled files, a file a micro-batch; the watermark waits for the whole span of the table, and a row of a
    later time without a run ends the source."""
    src = files.scratch_dir(spark, "k3-src")
    e = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "props")
    rows = e.select("user_id", "ts", "event_id", content_col().alias("content"))
    rows.repartition(4, F.md5(F.col("event_id").cast("string"))).write.mode("overwrite").parquet(src)
    span = rows.agg(F.min("ts").alias("a"), F.max("ts").alias("z"))
    seconds = span.select((F.unix_timestamp(F.col("z").cast("timestamp")) - F.unix_timestamp(F.col("a").cast("timestamp")) + 1).alias("s")).first()["s"] or 1
    own = st.streaming_session(spark)
    out, ck = files.scratch_dir(spark, "k3-out"), files.scratch_dir(spark, "k3-ckpt")
    stream = lambda: st.retry_state_stream(st.read_stream(own, src, TRACE_SCHEMA, "parquet", 1), 3, f"{seconds} seconds")
    st.run_available_now(stream(), out, ck, fmt="parquet")
    end = span.select(F.lit(None).cast("long").alias("user_id"), F.expr(f"z + make_interval(0, 0, 0, 0, 0, 0, {2 * seconds + 2})").alias("ts"),
                      F.lit(None).cast("long").alias("event_id"), F.lit(None).cast("string").alias("content")).where("ts is not null")
    end.write.mode("append").parquet(src)
    st.run_available_now(stream(), out, ck, fmt="parquet")
    return spark.read.schema(st.RETRY_OUT).parquet(out).select("user_id", "step", "retries", "action")
