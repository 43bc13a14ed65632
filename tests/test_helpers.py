"""Pure-Python helpers and column helpers that the oracles depend on."""

from pyspark.sql import functions as F

from tessera.functions.numeric import nudge_sql, r6
from tessera.functions.text import extract_reply


def test_nudge_sql_nested_and_strings():
    sql = "SELECT round(avg(x), 6) AS a, round(sum(CASE WHEN s = ',(' THEN 1 END) / 2.0, 1) AS b, lower('round(') FROM t"
    out = nudge_sql(sql)
    assert "round((avg(x)) + 1e-09, 6)" in out
    assert "round((sum(CASE WHEN s = ',(' THEN 1 END) / 2.0) + 1e-09, 1)" in out
    assert out.endswith("lower('round(') FROM t")


def test_r6_breaks_exact_ties_upward(spark):
    df = spark.createDataFrame([(0.5150875,), (-0.5150875,), (1.0,)], "x double")
    assert [r[0] for r in df.select(r6("x")).collect()] == [0.515088, -0.515087, 1.0]


def test_extract_reply_modes(spark):
    text = "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\n  a1 <|im_end|>\n<|im_start|>assistant\nb<|im_end|>x"
    df = spark.createDataFrame([(text, "q"), ("plain q answer ", "q")], "t string, p string")
    out = [(r[0], r[1]) for r in df.select(extract_reply(F.col("t"), "ppo", F.col("p")),
                                           extract_reply(F.col("t"), "trl")).collect()]
    assert out[0] == ("bx", "b")           # after the last marker; ppo removes end marks, trl cuts at the first
    assert out[1] == ("plain  answer", 'plain q answer ')
