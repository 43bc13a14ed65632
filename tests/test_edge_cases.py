"""Operator edge cases on a few literal rows (the cases listed in SURVEY §5)."""

from pyspark.sql import functions as F

from tessera.functions.text import char_tokens, ensure_question_mark, normalize_width, ustrip
from tessera.operators import chat, dedup, evaluate as ev, rewards, text, tokens, trace as tr
from tessera.operators.ordering import rank_in_groups, running_sum, with_global_index


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()] if cols else [tuple(r) for r in df.collect()]


def test_md_sections_preamble_level4_and_min_len(spark):
    body = "x" * 120
    md = f"preamble\n## A\n{body}\n#### not a cut\n{body}\n### B\nshort\n# top\n## C\n{body}"
    df = spark.createDataFrame([(1, md)], "doc_id long, text string")
    out = rows(text.md_sections(df).orderBy("block"), "block", "section")
    assert [b for b, _ in out] == [1, 3]
    assert out[0][1].startswith("## A") and "#### not a cut" in out[0][1]
    assert out[1][1].startswith("## C")


def test_md_no_heading_uses_paragraphs(spark):
    p = "y" * 150
    df = spark.createDataFrame([(1, f"{p}\n\n  \n\n{p}z\n\nshort")], "doc_id long, text string")
    out = rows(text.sections_or_paragraphs(df).orderBy("part"), "section")
    assert out == [(p,), (p + "z",)]


def test_width_table_and_char_tokens(spark):
    df = spark.createDataFrame([("ＡＢＣ１２３！",), ("’",), ("。",), ("＇",), ("",), ("",)], "t string")
    out = [r[0] for r in df.select(normalize_width(F.col("t"))).collect()]
    assert out == ["ABC123!", "'", "。", "＇", ".", ""]
    toks = [r[0] for r in df.select(char_tokens(F.col("t"))).collect()]
    assert toks[0] == list("ABC123!") and toks[-1] == []


def test_ustrip_unicode_whitespace(spark):
    df = spark.createDataFrame([("　a\n ",), ("\xa0b ",)], "t string")
    assert [r[0] for r in df.select(ustrip(F.col("t"))).collect()] == ["a", "b"]


def test_question_mark(spark):
    df = spark.createDataFrame([("why?",), ("why？",), ("why",)], "t string")
    assert [r[0] for r in df.select(ensure_question_mark(F.col("t"))).collect()] == ["why?", "why？", "why？"]


def test_expand_variants_empty_and_blank(spark):
    base = spark.createDataFrame([(1, "ans", ["a", "  ", ""]), (2, "ans2", [])],
                                 "base_id long, answer string, variants array<string>")
    out = rows(chat.expand_variants(base), "base_id", "pos", "question")
    assert out == [(1, 0, "a？")]


def test_loss_mask_marker_cases(spark):
    df = spark.createDataFrame([([5, 7, 8, 9, 3, 4], [7, 8]), ([5, 6], [7, 8]), ([5, 7], [7, 8]),
                                ([7, 8, 1, 7, 8, 2], [7, 8]), ([], [7, 8])], "ids array<int>, m array<int>")
    out = [r[0] for r in df.select(tokens.loss_mask_marker(F.col("ids"), F.col("m"), 2)).collect()]
    # marker at 0-based 1, length 2, +1 for the newline -> ones from position 4
    assert out[0] == [0, 0, 0, 0, 1, 1]
    assert out[1] == [0, 0]          # marker absent
    assert out[2] == [0, 0]          # marker cut off
    assert out[3] == [0, 0, 0, 1, 1, 1]  # first occurrence only, to the end
    assert out[4] == []


def test_labels_prompt_cut_and_shift(spark):
    df = spark.createDataFrame([([1, 2, 3, 4], 2), ([1, 2], 5)], "ids array<int>, p int")
    out = [r[0] for r in df.select(tokens.labels_prompt_cut(F.col("ids"), F.col("p"))).collect()]
    assert out == [[-100, -100, 3, 4], [-100, -100]]
    i, l, m = tokens.shift_align(F.col("ids"), F.col("ids"), F.col("ids"))
    assert [tuple(r) for r in df.select(i, l).collect()][0] == ([1, 2, 3], [2, 3, 4])


def test_group_advantage_group_of_one(spark):
    df = spark.createDataFrame([(1, 1, 2.0), (1, 2, 4.0), (2, 1, 9.0)], "g long, t long, reward double")
    out = {(r["g"], r["t"]): r["advantage"] for r in rewards.group_advantage(df, ["g"]).collect()}
    assert out[(2, 1)] == 0.0
    assert abs(out[(1, 1)] + out[(1, 2)]) < 1e-12 and out[(1, 2)] > 0


def test_format_reward_and_keywords(spark):
    df = spark.createDataFrame([("<|im_start|>a<|im_end|>",), ("<|im_start|>a<|im_start|>b<|im_end|>",), ("x",)],
                               "t string")
    assert [r[0] for r in df.select(rewards.reward_format(F.col("t"))).collect()] == [1.0, 0.5, 0.0]
    kw = spark.createDataFrame([("the the cat",)], "t string")
    assert kw.select(rewards.reward_keywords(F.col("t"), ["the", "dog"])).first()[0] == 0.5


def test_ranking_loss_stable(spark):
    df = spark.createDataFrame([(0.0,), (800.0,), (-800.0,)], "m double")
    out = [r[0] for r in df.select(rewards.ranking_loss(F.col("m"))).collect()]
    assert abs(out[0] - 0.6931471805599453) < 1e-12 and out[1] == 0.0 and abs(out[2] - 800.0) < 1e-9


def test_prf_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "label int, pred int")
    classes = spark.createDataFrame([(0,), (1,), (2,)], "cls int")
    per = {r["cls"]: r for r in ev.prf(ev.per_class_counts(df, "label", "pred", classes)).collect()}
    assert per[2]["precision"] == 0.0 and per[2]["recall"] == 0.0 and per[2]["f1"] == 0.0
    assert per[0]["precision"] == 1.0 and per[0]["recall"] == 0.5


def test_early_stopping_equal_loss_resets(spark):
    h = spark.createDataFrame([("r", e, l) for e, l in enumerate([1.0, 1.0, 1.1, 1.2, 1.3, 0.5])],
                              "run string, epoch int, loss double")
    out = ev.early_stopping(h, "run", "epoch", "loss", patience=3).first()
    assert out["stop_epoch"] == 4          # equal loss at epoch 1 counts as better
    out2 = ev.early_stopping(h, "run", "epoch", "loss", patience=3, delta=0.1).first()
    assert out2["stop_epoch"] == 3


def test_best_epoch_first_on_ties(spark):
    h = spark.createDataFrame([("r", 1, 0.5), ("r", 2, 0.9), ("r", 3, 0.9)], "run string, epoch int, acc double")
    assert ev.best_epoch(h, "run", "epoch", "acc").first()["best_epoch"] == 2


def test_argmax_first_on_ties(spark):
    df = spark.createDataFrame([([0.2, 0.4, 0.4],)], "p array<double>")
    assert df.select(ev.argmax(F.col("p"))).first()[0] == 1


def test_global_index_and_ranks_match_windows(spark):
    df = spark.range(0, 3000).select((F.col("id") % 3).alias("g"), ((F.col("id") * 7919) % 3001).alias("o"))
    # one hot group: a third of all rows in g = 0 plus a tiny group
    idx = with_global_index(df, [F.col("g"), F.col("o")], "_gidx", num_partitions=7)
    got = sorted(rows(idx, "g", "o", "_gidx"))
    assert [x[2] for x in got] == list(range(3000))
    r = rank_in_groups(df, ["g"], [F.col("o")], "rn")
    from pyspark.sql import Window
    w = df.withColumn("rn2", F.row_number().over(Window.partitionBy("g").orderBy("o")))
    assert sorted(rows(r, "g", "o", "rn")) == sorted(rows(w, "g", "o", "rn2"))
    rs = running_sum(df, ["g"], [F.col("o")], F.col("o"), "cum", num_partitions=5)
    w2 = df.withColumn("cum2", F.sum("o").over(Window.partitionBy("g").orderBy("o")))
    assert sorted(rows(rs, "g", "o", "cum")) == sorted(rows(w2, "g", "o", "cum2"))


def test_stratified_split_disjoint_complete(spark):
    df = spark.range(0, 500).select(F.col("id").alias("doc_id"), (F.col("id") % 4).cast("string").alias("lang"))
    s = ev.stratified_split(df, "doc_id", "lang", 0.8)
    assert s.count() == 500 and s.select("doc_id").distinct().count() == 500
    per = {(r["lang"], r["split"]): r["count"] for r in s.groupBy("lang", "split").count().collect()}
    assert per[("0", "train")] == 100 and per[("0", "test")] == 25


def test_pack_preserves_tokens(spark):
    df = spark.createDataFrame([(i, list(range(i % 7 + 1))) for i in range(50)], "k long, ids array<int>")
    p = tokens.pack_sequences(df, "k", "ids", 8, buckets=3)
    assert p.select(F.sum(F.size("packed"))).first()[0] == sum(i % 7 + 1 for i in range(50))
    assert p.select(F.max(F.size("packed"))).first()[0] <= 8


def test_dedup_first_wins(spark):
    df = spark.createDataFrame([(3, "A  b"), (1, "a b"), (2, "c")], "doc_id long, text string")
    out = sorted(rows(dedup.dedup_prefix(df, payload=["text"]), "doc_id", "text"))
    assert out == [(1, "a b"), (2, "c")]


def test_verify_gate_and_retry(spark):
    t = spark.createDataFrame([(1, 1, "ok"), (1, 2, "Error: x"), (1, 3, "ok"), (2, 1, "ok")],
                              "run long, step long, content string")
    v = sorted(rows(tr.verify_gate(t, "run", "step", "content"), "run", "step", "status"))
    assert v == [(1, 1, "passed"), (1, 2, "Verification Failed: Error: x"), (2, 1, "passed")]
    fails = spark.createDataFrame([(1, s, "Error: e") for s in range(1, 7)], "run long, step long, content string")
    r = sorted(rows(tr.retry_budget(fails, "run", ["step"], "content", 3), "step", "retries", "action"))
    assert r[-1] == (4, 4, "stop") and len(r) == 4


def test_path_search_cycle(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "c"), ("c", "d"), ("a", "d")], "src string, dst string")
    from tessera.operators.graph import path_search
    out = [(r["path"], r["depth"]) for r in path_search(e, "a", "d").collect()]
    assert out == [(["a", "d"], 1)]
    out2 = sorted(tuple(r["path"]) for r in path_search(e, "b", "d").collect())
    assert out2 == [("b", "a", "d"), ("b", "c", "d")]


def test_knn_exact_against_brute_force(spark):
    import random
    random.seed(1)
    vecs = [(i, [random.random() for _ in range(4)]) for i in range(60)]
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<double>")
    from tessera.operators.nearest import knn_join
    got = sorted(rows(knn_join(df.where("vec_id < 5"), df, "vec_id", "vec_id", "embedding", 3, pivots=5, block=13),
                      "query_id", "rank", "neighbor_id"))
    want = []
    for q, qv in vecs[:5]:
        d = sorted((sum((a - b) ** 2 for a, b in zip(qv, v)), c) for c, v in vecs if c != q)[:3]
        want += [(q, r + 1, c) for r, (_, c) in enumerate(d)]
    assert got == sorted(want)
