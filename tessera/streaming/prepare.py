"""Structured Streaming operators (K1-K3).

K1 is the record-by-record preparation loop as a stateless stream; K2 keeps the
"questions seen" set as a stored table that every micro-batch is checked against (or as
state bounded by a watermark); K3 counts retries per run in event order with
``transformWithStateInPandas`` (list state, event-time timers, RocksDB). All three write files
with a checkpoint, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tessera.functions.text import ensure_question_mark, ustrip
from tessera.operators.ordering import settled

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_available_now(df: DataFrame, out: str, checkpoint: str, fmt: str = "json", mode: str = "append") -> str:
    """Process everything available now, then stop (incremental on rerun)."""
    q = (df.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode(mode)
         .trigger(availableNow=True).start(out))
    q.awaitTermination()
    return out


def prepare_stream(src: DataFrame) -> DataFrame:
    """K1: P1 (strip, require instruction and output), C7 (variants -> rows), T9."""
    s = (src.withColumn("instruction", ustrip(F.col("instruction")))
         .withColumn("output", ustrip(F.col("output")))
         .where(F.col("instruction").isNotNull() & (F.length("instruction") > 0)
                & F.col("output").isNotNull() & (F.length("output") > 0)))
    ex = s.select("base_id", "ts", "output", F.posexplode("paraphrases").alias("pos", "_q"))
    ex = ex.withColumn("_q", ustrip(F.col("_q"))).where(F.col("_q").isNotNull() & (F.length("_q") > 0))
    return ex.select("base_id", "pos", "ts", ensure_question_mark(F.col("_q")).alias("question"),
                     F.col("output").alias("answer"))


def dedup_stream(prepared: DataFrame, key: str = "question", delay: str | None = None) -> DataFrame:
    """K2 in the state store: drop a question already seen, however late it comes (the state holds every key).

    With ``delay`` the state of older keys is evicted, and rows that come later than the watermark are
    lost: only for streams that may lose them. ``dedup_batches`` bounds the state without losing rows.
    """
    if delay is None:
        return prepared.dropDuplicates([key])
    return prepared.withWatermark("ts", delay).dropDuplicatesWithinWatermark([key])


def dedup_batches(prepared: DataFrame, folder: str, checkpoint: str, key: str, order: list[str]) -> None:
    """K2 with nothing in the state store: ``foreachBatch`` against stored keys; processes what is available, then stops.

    Under ``folder``: ``first`` holds the first row of each key as it came, ``late`` rows that came in a later batch and
    stand before it in ``order`` (``settled_first`` picks between them). A batch is cut to one row a key, then only its
    keys are looked up: the stored table is scanned and semi-joined to them (the batch is the side that may be broadcast, by
    its run-time size), never shuffled for them as a whole or collected. Each batch writes its own folder and reads
    only those of earlier batches, so a batch that is run again after a failure writes the same rows once. Null keys
    are a key. What grows is the stored table, one row a key; the query's state does not.
    """
    columns = prepared.columns

    def one(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        first = (rows.groupBy(F.col(key).alias("_k")).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("_r")).select("_r.*"))
        first = first.withColumn("_key", F.md5(F.coalesce(F.concat(F.lit("k"), F.col(key)), F.lit("null"))))
        stored = _stored(spark, f"{folder}/first", first.schema, batch)
        if stored is None:
            first.write.mode("overwrite").parquet(f"{folder}/first/batch={batch}")
            return
        first = settled(first)
        known = settled(stored.join(first.select("_key"), "_key", "left_semi"))
        seen = known.select("_key", F.struct(*order).alias("_was"))
        late = first.join(seen, "_key").where(F.struct(*order) < F.col("_was")).drop("_was")
        first.join(seen, "_key", "left_anti").write.mode("overwrite").parquet(f"{folder}/first/batch={batch}")
        late.write.mode("overwrite").parquet(f"{folder}/late/batch={batch}")

    q = prepared.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def _stored(spark: SparkSession, path: str, schema: T.StructType, before: int) -> DataFrame | None:
    """The rows that batches before ``before`` wrote under ``path``; None if there is none."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not before or not root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root):
        return None
    whole = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    return spark.read.schema(whole).parquet(path).where(F.col("batch") < before).drop("batch")


def settled_first(spark: SparkSession, folder: str, schema: T.StructType, order: list[str]) -> DataFrame:
    """The first row of every key by ``order`` (equal to the batch operator D2): stored rows, or late ones that stand before them."""
    keyed = T.StructType([*schema.fields, T.StructField("_key", T.StringType())])
    parts = [p for name in ("first", "late") if (p := _stored(spark, f"{folder}/{name}", keyed, 1 << 62)) is not None]
    if not parts:
        return spark.createDataFrame([], schema)
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    names = [f.name for f in schema.fields]
    return rows.groupBy("_key").agg(F.min_by(F.struct(*names), F.struct(*order)).alias("_r")).select("_r.*")


RETRY_OUT = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("step", T.LongType()),
                          T.StructField("retries", T.LongType()), T.StructField("action", T.StringType())])
ROWS = T.StructType([T.StructField("rows", T.BinaryType())])
CHUNK = 50_000  # rows of a frame or of a stored piece that a processor hands on
GROUPS = 1024  # runs are dealt to so many groups by a hash; each has one state


def streaming_session(spark: SparkSession) -> SparkSession:
    """A session of the same application for streams with state: RocksDB is set there, the caller's settings stay."""
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    own.conf.set("spark.sql.session.timeZone", "UTC")
    return own


def retry_budget_processor(max_retries: int = 3, idle_ms: int | None = None) -> StatefulProcessor:
    """K3 processor of a group of runs. The class is built inside this function so it travels to the Python
    workers by value: they need pyspark, not this package, on their path."""
    chunk = CHUNK
    waiting_rows = np.dtype([("user_id", "i8"), ("ts", "i8"), ("event_id", "i8"), ("failed", "?")])
    counts = np.dtype([("user_id", "i8"), ("step", "i8"), ("retries", "i8"), ("last", "i8")])
    names = ["user_id", "step", "retries", "action"]

    class RetryBudget(StatefulProcessor):
        """K3: per run, count steps and failures in event order; stop (and ignore later steps) once the
        failures exceed ``max_retries``.

        The key is a group of runs, so that calls to the state store grow with the groups and not with the runs. Rows
        wait in a list state (run, time, id and whether they failed: no texts; a piece holds many) until the watermark
        has passed them; an event-time timer for the first of them then takes those that are due, run by run in the order
        of (ts, event_id), so the order holds over any micro-batches. A run is counted on with three numbers. With ``idle_ms``
        the numbers of a run without rows for so long are removed by a later timer (its time to live).
        """

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.budget = handle.getListState("budget", ROWS)  # the counts of the group's runs, by run
            self.waiting = handle.getListState("waiting", ROWS)

        def stored(self, state, kind: np.dtype) -> np.ndarray:
            pieces = [np.frombuffer(bytes(r[0]), kind) for r in state.get()] if state.exists() else []
            return np.concatenate(pieces) if pieces else np.empty(0, kind)

        def store(self, state, rows: np.ndarray) -> None:
            if len(rows):
                state.put([(rows[k:k + chunk].tobytes(),) for k in range(0, len(rows), chunk)])
            else:
                state.clear()

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            held = None
            for part in rows:  # a frame at a time, never all rows of the key
                part = part[part["counts"]]
                if not len(part):
                    continue
                new = np.empty(len(part), waiting_rows)
                new["user_id"] = part["user_id"].astype("int64")
                new["ts"] = part["ts"].astype("datetime64[us]").astype("int64")
                new["event_id"] = part["event_id"].astype("int64")
                new["failed"] = part["content"].fillna("").astype(str).str.startswith("Error:")
                if held is None:
                    held = self.stored(self.budget, counts)
                    over = held["user_id"][held["retries"] > max_retries]
                # rows of a run that was stopped only say when it was last seen
                new = new[~np.isin(new["user_id"], over)] if not idle_ms else new
                for k in range(0, len(new), chunk):
                    self.waiting.appendValue((new[k:k + chunk].tobytes(),))
                if len(new):
                    self.handle.registerTimer(int(new["ts"].min()) // 1000)
            yield pd.DataFrame(columns=names)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
            pending, held = self.stored(self.waiting, waiting_rows), self.stored(self.budget, counts)
            due = pending["ts"] // 1000 <= now
            rest, rows = pending[~due], pending[due]
            if len(rows):
                rows = rows[np.lexsort((rows["failed"], rows["event_id"], rows["ts"], rows["user_id"]))]
                runs, start, of, n = np.unique(rows["user_id"], return_index=True, return_inverse=True, return_counts=True)
                fresh = np.zeros(int((~np.isin(runs, held["user_id"])).sum()), counts)
                fresh["user_id"] = runs[~np.isin(runs, held["user_id"])]
                held = np.concatenate([held, fresh])
                held = held[np.argsort(held["user_id"], kind="stable")]
                at = np.searchsorted(held["user_id"], runs)
                step = held["step"][at][of] + np.arange(len(rows)) - start[of] + 1
                bad = np.cumsum(rows["failed"])
                retries = held["retries"][at][of] + bad - (bad[start] - rows["failed"][start])[of]
                counted = retries - rows["failed"] <= max_retries  # steps after the stop don't count
                step, retries, user = step[counted], retries[counted], rows["user_id"][counted]
                if len(user):
                    final = np.flatnonzero(np.append(user[1:] != user[:-1], True))
                    where = np.searchsorted(held["user_id"], user[final])
                    held["step"][where], held["retries"][where] = step[final], retries[final]
                held["last"][at] = np.maximum(held["last"][at], rows["ts"][start + n - 1] // 1000)
                over = held["user_id"][held["retries"] > max_retries]
                rest = rest[~np.isin(rest["user_id"], over)] if not idle_ms else rest
                action = np.where(retries > max_retries, "stop", "continue")
                for k in range(0, len(user), chunk):
                    some = slice(k, k + chunk)
                    yield pd.DataFrame(dict(zip(names, (user[some], step[some], retries[some], action[some]))))
                self.store(self.waiting, rest)
                if len(rest):
                    self.handle.registerTimer(int(rest["ts"].min()) // 1000)
            if idle_ms:
                idle = (held["last"] + idle_ms <= now) & ~np.isin(held["user_id"], rest["user_id"])
                if idle.any() or len(rows):
                    held = held[~idle]
                    if len(held):
                        self.handle.registerTimer(int(held["last"].min()) + idle_ms)
            if len(rows) or idle_ms:
                self.store(self.budget, held)
            yield pd.DataFrame(columns=names)

        def close(self) -> None:
            pass

    return RetryBudget()


def retry_state_stream(trace: DataFrame, max_retries: int = 3, delay: str = "0 seconds", idle_ms: int | None = None) -> DataFrame:
    """K3 on a streaming trace ``user_id, ts, event_id, content`` of a session made by ``streaming_session``.

    A row counts when the watermark (the latest time seen less ``delay``) has passed it; rows that come later than the
    watermark are late and left out, as Spark does. The rows of the last ``delay`` therefore wait for later ones: a source
    ends with a row of a later time (any run, null for instance) if all of them must come out. Rows without a run, a time or
    an id are not counted; they do move the watermark.
    """
    # no filter here: it would be pushed below the watermark, which rows without a run move too
    timed = trace.select(F.pmod(F.xxhash64("user_id"), F.lit(GROUPS)).cast("int").alias("runs"),
                         F.coalesce(F.col("user_id").cast("long"), F.lit(0).cast("long")).alias("user_id"), F.col("ts").cast("timestamp").alias("ts"),
                         F.coalesce("event_id", F.lit(0).cast("long")).alias("event_id"), "content",
                         (F.col("user_id").isNotNull() & F.col("event_id").isNotNull() & F.col("ts").isNotNull()).alias("counts")).withWatermark("ts", delay)
    return (timed.groupBy("runs")
            .transformWithStateInPandas(statefulProcessor=retry_budget_processor(max_retries, idle_ms), outputStructType=RETRY_OUT,
                                        outputMode="Append", timeMode="EventTime"))


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json", files_a_batch: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    return (r.option("maxFilesPerTrigger", files_a_batch) if files_a_batch else r).load(path)
