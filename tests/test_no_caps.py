"""Rows that a cap, a prefix, a fixed list or an assumed numbering would lose."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import ensure_question_mark, extract_reply
from tessera.operators import chat, dedup, tokens
from tessera.operators.graph import path_search
from tessera.operators.text import extract_json_pair, parse_tool_call, validate_struct
from tessera.sources import files
from tessera.streaming import prepare as st


def dialog(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_pairs_go_to_the_next_turn_whatever_the_numbers(spark):
    t = dialog(spark, [(1, 0, "user", "q0"), (1, 2, "assistant", "a2"), (1, 3, "user", "q3"), (1, 5, "assistant", "a5"),
                       (2, 1, "user", "x"), (2, 2, "assistant", "y"), (3, 7, "user", "alone")])
    got = sorted(map(tuple, chat.user_assistant_pairs(t).collect()))
    assert got == [(1, 0, "q0", "a2"), (1, 3, "q3", "a5"), (2, 1, "x", "y")]


def test_multiturn_prompt_never_holds_its_own_answer(spark):
    t = dialog(spark, [(1, 1, "user", "q1"), (1, 2, "assistant", "first"), (1, 5, "user", "q5"), (1, 9, "assistant", "second")])
    got = {r.turn: r.prompt for r in chat.to_multiturn_samples(t).collect()}
    assert "first" not in got[2] and "q1" in got[2] and "second" not in got[9] and "first" in got[9] and "q5" in got[9]


def test_texts_that_differ_late_are_both_kept(spark):
    head = "same words " * 60
    df = spark.createDataFrame([(1, head + "one"), (2, head + "two"), (3, head.upper() + " ONE")], "doc_id long, text string")
    assert sorted(r.doc_id for r in dedup.dedup_prefix(df, payload=["text"]).collect()) == [1, 2]
    assert [r.doc_id for r in dedup.dedup_prefix(df, payload=["text"], n=240).collect()] == [1]


def test_vocabulary_and_encoding_hold_every_character(spark):
    chars = "".join(chr(0x4E00 + k) for k in range(300))
    texts = spark.createDataFrame([(chars,), (chars[:5],)], "text string")
    v = tokens.build_vocab(texts, "text")
    assert v.count() == 300
    df = spark.createDataFrame([(1, list(chars)), (2, ["?", chars[0]]), (3, []), (4, None)], "k long, t array<string>")
    got = {r.k: r.ids for r in tokens.vocab_encode(df, ["k"], "t", v, "ids").collect()}
    assert sorted(got[1]) == list(range(2, 302)) and got[2] == [tokens.UNK_ID, got[1][0]] and got[3] == [] and got[4] == []


def test_batches_are_padded_to_their_longest_row(spark):
    df = spark.createDataFrame([(0, [1] * 900, [1] * 900), (0, [2], [2])], "batch long, ids array<int>, labels array<int>")
    assert {len(r.ids) for r in tokens.pad_batch(df, "batch", "ids", "labels").collect()} == {900}
    assert {len(r.ids) for r in tokens.pad_batch(df, "batch", "ids", "labels", 512).collect()} == {512}


def test_mask_by_true_length_keeps_an_end_mark_that_is_the_pad(spark):
    df = spark.createDataFrame([([5, 6, 0, 0, 0], 3)], "ids array<int>, n int")
    assert df.select(tokens.attention_mask(F.col("ids"), length=F.col("n"))).first()[0] == [1, 1, 1, 0, 0]


def test_paths_have_no_depth_limit_and_all_shortest_are_returned(spark):
    chain = [(f"s{k}", f"s{k + 1}") for k in range(12)] + [("s0", "t1"), ("t1", "s2"), ("s3", "s3"), ("s5", "s1")]
    e = spark.createDataFrame(chain, "src string, dst string")
    got = path_search(e, "s0", "s12").collect()
    assert sorted(r.path[1] for r in got) == ["s1", "t1"] and {r.depth for r in got} == {12}
    assert path_search(e, "s12", "s0").count() == 0


def test_question_mark_tool_name_and_reply_without_marker(spark):
    df = spark.createDataFrame([("why?\n",), ("why？",), ("why",)], "t string")
    assert [r[0] for r in df.select(ensure_question_mark("t")).collect()] == ["why?\n？", "why？", "why？"]
    calls = spark.createDataFrame([("查询('x')",)], "t string")
    assert [(r.tool, r.query) for r in parse_tool_call(calls, "t").collect()] == [("查询", "x")]
    plain = spark.createDataFrame([("<|im_start|>user\nhi<|im_end|>",)], "t string")
    assert plain.select(extract_reply(F.col("t"), "trl")).first()[0] == "user\nhi"


def test_newest_file_is_read_alone(spark):
    import os
    root = files.scratch_dir(spark, "newest")
    for k, v in enumerate(("old", "new")):
        spark.createDataFrame([(v,)], "value string").coalesce(1).write.mode("append").text(root)
        local = root.removeprefix("file:")
        for f in os.listdir(local):
            if f.startswith("part-") and open(os.path.join(local, f)).read().strip() == v:
                os.utime(os.path.join(local, f), (1_700_000_000 + k, 1_700_000_000 + k))
    assert [r.value for r in files.latest_version_file(spark, root).collect()] == ["new"]


def test_stream_dedup_loses_no_late_row(spark):
    schema = T.StructType([T.StructField("question", T.StringType()), T.StructField("ts", T.TimestampType())])
    src, out, ck = (files.scratch_dir(spark, n) for n in ("late-src", "late-out", "late-ck"))
    day = lambda d: dt.datetime(2024, 1, d)
    for rows in ([("a", day(10)), ("b", day(10))], [("c", day(20)), ("a", day(20))], [("late", day(1)), ("b", day(1))]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
        st.run_available_now(st.dedup_stream(st.read_stream(spark, src, schema, "parquet")), out, ck, "parquet")
    assert sorted(r.question for r in spark.read.parquet(out).collect()) == ["a", "b", "c", "late"]


def test_json_pairs_are_strict(spark):
    good = '{"instruction":" a ","output":"b"}'
    rows = [(good, None), ("see " + good + " done", None), (good + ' and {"x":1}', "bad_json"), ("{'instruction':'a','output':'b'}", "bad_json"),
            ('{"instruction":5,"output":"b"}', "not_text"), (good + " }", "bad_json"), (good + "," + good, "bad_json"), ("none", "no_json"),
            ('{"instruction":"  ","output":"b"}', "empty_field"), ('{"output":"b"}', "empty_field"), ('{"instruction":null,"output":"b"}', "empty_field")]
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(rows)], "k int, t string")
    got = {r.k: (r.reason, r.instruction) for r in extract_json_pair(df, "t").collect()}
    assert [got[k][0] for k in range(len(rows))] == [r for _, r in rows] and got[0][1] == "a"


def test_struct_rules_cover_ranges_values_and_list_lengths(spark):
    rows = ['{"score":3,"kind":"a","tags":["x"]}', '{"score":30,"kind":"a","tags":[]}', '{"score":3,"kind":"z","tags":[]}',
            '{"score":3,"kind":"a","tags":["x","y","z"]}', '{"score":3,"tags":[]}']
    df = spark.createDataFrame([(t,) for t in rows], "t string")
    got = [r.reason for r in validate_struct(df, "t", "score int, kind string, tags array<string>", {"score": (0, 10)}, {"kind": ["a", "b"]}, {"tags": 2}).collect()]
    assert got == [None, "score:range", "kind:enum", "tags:length", "kind:missing"]
