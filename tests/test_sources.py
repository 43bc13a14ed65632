"""Sources and sinks on small inputs."""

import time

import pytest
from pyspark.sql import types as T

from tessera.sources import files


def test_from_records_explicit_schema(spark):
    schema = T.StructType([T.StructField("instruction", T.StringType()), T.StructField("response", T.StringType())])
    df = files.from_records(spark, [{"instruction": "q", "response": "a"}, {"instruction": "q2"}], schema)
    assert [tuple(r) for r in df.collect()] == [("q", "a"), ("q2", None)]


def test_jsonl_roundtrip_keeps_utf8_and_corrupt_rows(spark):
    out = files.scratch_dir(spark, "t-jsonl")
    schema = T.StructType([T.StructField("instruction", T.StringType()), T.StructField("output", T.StringType())])
    files.sink_jsonl(spark.createDataFrame([("今天天气怎么样？", "晴天")], schema), out)
    paths = __import__("glob").glob(out.replace("file:", "") + "/*.json")
    raw = "".join(open(p, encoding="utf-8").read() for p in paths)
    assert "今天天气怎么样" in raw
    back = files.scan_jsonl(spark, out, schema).collect()
    assert back[0]["instruction"] == "今天天气怎么样？" and back[0]["_corrupt_record"] is None


def test_sink_refuses_its_own_input(spark):
    out = files.scratch_dir(spark, "t-self")
    spark.range(3).write.parquet(out)
    df = spark.read.parquet(out)
    with pytest.raises(ValueError):
        files.sink_overwrite(df, out)


def test_latest_version_file(spark):
    root = files.scratch_dir(spark, "t-latest")
    spark.createDataFrame([("old",)], "value string").coalesce(1).write.text(root + "/v1")
    time.sleep(1.1)
    spark.createDataFrame([("new",)], "value string").coalesce(1).write.text(root + "/v2")
    rows = files.latest_version_file(spark, root + "/*/*.txt").collect()
    assert [r["value"] for r in rows] == ["new"]


def test_json_array_positions(spark):
    out = files.scratch_dir(spark, "t-arr")
    v = spark.createDataFrame([("<PAD>", 0), ("<UNK>", 1), ("a", 2)], "token string, id int")
    files.write_json_array(v, "token", "id", out)
    got = sorted((r["token"], r["id"]) for r in files.scan_json_array(spark, out).collect())
    assert got == [("<PAD>", 0), ("<UNK>", 1), ("a", 2)]
