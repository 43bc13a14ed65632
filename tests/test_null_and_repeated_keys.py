"""Rows whose group or id is null, or whose id repeats, keep their places."""

from pyspark.sql import functions as F

from tessera.operators import chat, evaluate as ev, ordering, rewards, tokens as tk, trace as tr


def test_split_and_sequence_ids_keep_rows_without_a_class(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "b")], "id long, label string")
    s = ev.stratified_split(df, "id", "label", 0.5).collect()
    assert sorted(r["id"] for r in s) == [1, 2, 3, 4, 5]
    assert sorted(r["split"] for r in s if r["label"] is None) == ["test", "train"]
    assert ev.sequence_ids(df, "label", "id").count() == 5
    d = ev.class_distribution(ev.stratified_split(df, "id", "label", 0.5), "label", "split")
    assert sum(r["n"] for r in d.collect()) == 5


def test_batches_number_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "d")], "id long, v string")
    got = tk.assign_batches(df, "id", 2).collect()
    assert sorted(r["v"] for r in got) == ["a", "b", "c", "d"] and sorted(r["batch"] for r in got) == [0, 0, 1, 1]


def test_advantage_of_a_group_without_a_prompt(spark):
    df = spark.createDataFrame([("p", 1.0), ("p", 3.0), (None, 1.0), (None, 3.0)], "g string, reward double")
    got = rewards.group_advantage(df, ["g"]).collect()
    assert len(got) == 4 and sorted(r["advantage"] for r in got if r["g"] is None) == sorted(r["advantage"] for r in got if r["g"])


TRACE = [(None, 1, "Error: x"), (None, 2, "ok"), (7, 1, "ok")]


def test_gate_and_budget_of_a_run_without_a_name(spark):
    df = spark.createDataFrame(TRACE, "run long, step long, content string")
    assert sorted((r["run"] or 0, r["step"], r["status"]) for r in tr.verify_gate(df, "run", "step", "content").collect()) == [
        (0, 1, "Verification Failed: Error: x"), (7, 1, "passed")]
    moved = df.withColumnRenamed("step", "at")
    got = tr.retry_budget(moved, "run", ["at"], "content", 0).collect()
    assert sorted((r["run"] or 0, r["step"], r["action"]) for r in got) == [(0, 1, "stop"), (7, 1, "continue")]


def test_transitions_of_a_run_without_a_name(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b")], "run long, step long, agent string")
    idx = ordering.with_global_index(df, [F.col("run"), F.col("step")], "_gidx")
    assert [(r["from_agent"], r["to_agent"], r["n"]) for r in tr.agent_transitions(idx, "run", "agent").collect()] == [("a", "b", 1)]


def test_dialogs_without_an_id(spark):
    turns = spark.createDataFrame([(None, 0, "user", "q"), (None, 1, "assistant", "a."), (1, 0, "user", "x"), (1, 1, "assistant", "y")],
                                  "conv_id long, turn long, role string, text string")
    assert chat.user_assistant_pairs(turns).count() == 2
    assert chat.to_multiturn_samples(turns).count() == 2


def test_encoding_and_packing_of_null_and_repeated_keys(spark):
    vocab = spark.createDataFrame([("a", 5)], "token string, id int")
    df = spark.createDataFrame([(None, ["a"]), (1, ["a", "z"]), (1, ["a"])], "k long, t array<string>")
    assert sorted(r["input_ids"] for r in tk.vocab_encode(df, ["k"], "t", vocab).collect()) == [[5], [5], [5, 1]]
    seqs = spark.createDataFrame([(1, [1, 2]), (1, [3]), (None, [4, 5, 6])], "k long, ids array<int>")
    packed = [x for r in tk.pack_sequences(seqs, "k", "ids", 4, 2).collect() for x in r["packed"]]
    assert sorted(packed) == [1, 2, 3, 4, 5, 6]


def test_a_null_label_has_its_support(spark):
    df = spark.createDataFrame([(None, 1), (1, 1), (None, None)], "y int, p int")
    classes = spark.createDataFrame([(None,), (1,)], "cls int")
    got = {r["cls"]: (r["support"], r["predicted"]) for r in ev.per_class_counts(df, "y", "p", classes).collect()}
    assert got == {None: (2, 1), 1: (1, 2)}


def test_many_equal_rows_spread_over_partitions(spark):
    df = spark.range(4000).select(F.when(F.col("id") < 1500, None).otherwise(F.col("id")).alias("k"))
    placed = ordering.with_global_index(df, [F.col("k")], "i", 8)
    assert sorted(r["i"] for r in placed.collect()) == list(range(4000))
    sizes = df.withColumn("_came", F.monotonically_increasing_id()).repartitionByRange(8, "k", "_came").groupBy(F.spark_partition_id()).count()
    assert max(r["count"] for r in sizes.collect()) < 2 * 4000 / 8
