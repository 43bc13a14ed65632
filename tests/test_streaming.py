"""Streaming: restart from the checkpoint processes only new input (exactly once), and
the stateful K3 keeps its counters across micro-batches."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources import files
from tessera.streaming import prepare as st

BASE = T.StructType([T.StructField("base_id", T.LongType()), T.StructField("ts", T.TimestampType()),
                     T.StructField("instruction", T.StringType()), T.StructField("output", T.StringType()),
                     T.StructField("paraphrases", T.ArrayType(T.StringType()))])
TRACE = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("ts", T.TimestampType()),
                      T.StructField("event_id", T.LongType()), T.StructField("content", T.StringType())])


def _base(spark, rows):
    return spark.createDataFrame(rows, BASE)


def test_prepare_stream_restart_is_incremental(spark):
    src, out, ck = (files.scratch_dir(spark, n) for n in ("ts-src", "ts-out", "ts-ck"))
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    _base(spark, [(1, t0, "q", " a ", ["x", " ", "y?"]), (2, t0, "q2", "  ", ["z"])]).write.mode("append").json(src)
    st.run_available_now(st.prepare_stream(st.read_stream(spark, src, BASE)), out, ck)
    first = sorted((r["base_id"], r["question"], r["answer"]) for r in spark.read.json(out).collect())
    assert first == [(1, "x？", "a"), (1, "y?", "a")]          # blank output dropped (P1), blank variant dropped
    _base(spark, [(3, t0, "q3", "b", ["w"])]).write.mode("append").json(src)
    st.run_available_now(st.prepare_stream(st.read_stream(spark, src, BASE)), out, ck)
    second = sorted((r["base_id"], r["question"]) for r in spark.read.json(out).collect())
    assert second == [(1, "x？"), (1, "y?"), (3, "w？")]       # no row written twice


def test_retry_state_carries_over_batches(spark):
    import datetime as dt
    src, out, ck = (files.scratch_dir(spark, n) for n in ("tr-src", "tr-out", "tr-ck"))
    t = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    rows1 = [(7, t(1), 1, "Error: a"), (7, t(2), 2, "Error: b"), (7, t(3), 3, "ok")]
    spark.createDataFrame(rows1, TRACE).write.mode("append").parquet(src)
    st.run_available_now(st.retry_state_stream(st.read_stream(st.streaming_session(spark), src, TRACE, "parquet"), 2), out, ck, "parquet")
    rows2 = [(7, t(4), 4, "Error: c"), (7, t(5), 5, "ok")]
    spark.createDataFrame(rows2, TRACE).write.mode("append").parquet(src)
    st.run_available_now(st.retry_state_stream(st.read_stream(st.streaming_session(spark), src, TRACE, "parquet"), 2), out, ck, "parquet")
    got = sorted((r["step"], r["retries"], r["action"]) for r in spark.read.parquet(out).collect())
    assert got == [(1, 1, "continue"), (2, 2, "continue"), (3, 2, "continue"), (4, 3, "stop")]


def test_stored_keys_equal_the_batch_operator_over_batches_and_a_rerun(spark):
    import random
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", "c", "d", None, "e"]), i, rng.randrange(3)) for i in range(60)]
    rng.shuffle(rows)
    schema = T.StructType([T.StructField("question", T.StringType()), T.StructField("base_id", T.LongType()), T.StructField("pos", T.LongType())])
    src, out, ck = (files.scratch_dir(spark, n) for n in ("td-src", "td-out", "td-ck"))
    for k in range(0, 60, 20):
        spark.createDataFrame(rows[k:k + 20], schema).coalesce(2).write.mode("append").json(src)
        for _ in range(2):  # the second run has nothing to do
            st.dedup_batches(st.read_stream(spark, src, schema, files_a_batch=1), out, ck, "question", ["base_id", "pos"])
        seen = {}
        for q, b, p in rows[:k + 20]:
            seen[q] = min(seen.get(q, (b, p)), (b, p))
        got = {r["question"]: (r["base_id"], r["pos"]) for r in st.settled_first(spark, out, schema, ["base_id", "pos"]).collect()}
        assert got == seen
    assert spark.read.parquet(f"{out}/first").groupBy("_key").count().where("count > 1").count() == 0


def test_retries_in_event_order_over_shuffled_batches_and_a_hot_run(spark):
    import datetime as dt
    import random
    rng = random.Random(4)
    t = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    rows = [(u, t(rng.randrange(3000)), 1000 * u + i, rng.choice(["Error: x", "ok", "ok", None])) for u in range(5) for i in range(20)]
    rows += [(9, t(k // 10), 10 ** 6 + k, "ok") for k in range(20_000)] + [(9, t(2500), 10 ** 6 + 20_000, "Error: z")]
    rng.shuffle(rows)
    src, out, ck = (files.scratch_dir(spark, n) for n in ("to-src", "to-out", "to-ck"))
    own = st.streaming_session(spark)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    run = lambda: st.run_available_now(st.retry_state_stream(st.read_stream(own, src, TRACE, "parquet", 1), 3, "4000 seconds"), out, ck, "parquet")
    for k in range(3):
        spark.createDataFrame(rows[k::3], TRACE).coalesce(1).write.mode("append").parquet(src)
    run()
    spark.createDataFrame([(None, t(20_000), None, None)], TRACE).write.mode("append").parquet(src)
    run()
    want = []
    for u in {r[0] for r in rows}:
        step = bad = 0
        for r in sorted((r for r in rows if r[0] == u), key=lambda r: (r[1], r[2])):
            step, bad = step + 1, bad + (r[3] or "").startswith("Error:")
            want.append((u, step, bad, "stop" if bad > 3 else "continue"))
            if bad > 3:
                break
    assert sorted(tuple(r) for r in spark.read.schema(st.RETRY_OUT).parquet(out).collect()) == sorted(want)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before


def test_state_grows_with_groups_not_with_runs(spark, monkeypatch):
    import datetime as dt
    monkeypatch.setattr(st, "GROUPS", 8)
    t = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    rows = [(2 ** 60 + u, t(10 * k + u % 10), 100 * u + k, "Error: x" if (u + k) % 2 else "ok") for u in range(300) for k in range(6)]
    src, out, ck = (files.scratch_dir(spark, n) for n in ("tg-src", "tg-out", "tg-ck"))
    for k in range(2):
        spark.createDataFrame(rows[k::2] + [(None, t(0), 1, "ok")], TRACE).coalesce(1).write.mode("append").parquet(src)
    spark.createDataFrame([(None, t(9000), None, None)], TRACE).coalesce(1).write.mode("append").parquet(src)
    stream = st.retry_state_stream(st.read_stream(st.streaming_session(spark), src, TRACE, "parquet", 1), 1, "4000 seconds")
    q = stream.writeStream.format("parquet").option("checkpointLocation", ck).trigger(availableNow=True).start(out)
    q.awaitTermination()
    assert 0 < max(o["numRowsTotal"] for p in q.recentProgress for o in p["stateOperators"]) < 100
    want = []
    for u in range(300):
        bad = 0
        for k in range(6):
            bad += (u + k) % 2
            want.append((2 ** 60 + u, k + 1, bad, "stop" if bad > 1 else "continue"))
            if bad > 1:
                break
    assert sorted(tuple(r) for r in spark.read.schema(st.RETRY_OUT).parquet(out).collect()) == sorted(want)
