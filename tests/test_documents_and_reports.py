"""Metrics document, wanted classes, version folders, preference pairs by prompt, class counts, recall of the report."""

import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import evaluate as ev, rewards
from tessera.sources import files

COUNTS = [("a", "a", 3), ("a", "b", 1), ("b", "a", 2), (None, "a", 4), ("c", None, 5)]


def counted(spark):
    return spark.createDataFrame(COUNTS, "y string, p string, n long")


def test_class_counts_take_nulls_as_a_class(spark):
    got = {r["cls"]: (r["support"], r["tp"], r["predicted"]) for r in ev.class_counts(counted(spark), "y", "p", "n").collect()}
    assert got == {"a": (4, 3, 9), "b": (2, 0, 1), "c": (5, 0, 0), None: (4, 0, 5)}


def test_report_lines(spark):
    df = spark.createDataFrame([("a", "a", 3), ("a", "b", 1), ("b", "b", 4)], "y string, p string, n long")
    got = {r["label"]: r for r in ev.classification_report(ev.class_counts(df, "y", "p", "n")).collect()}
    assert set(got) == {"a", "b", "macro avg", "weighted avg", "accuracy"}
    assert got["accuracy"]["f1"] == 7 / 8 and got["accuracy"]["support"] == 8 and got["accuracy"]["precision"] is None
    assert got["macro avg"]["recall"] == pytest.approx((3 / 4 + 1) / 2) and got["weighted avg"]["precision"] == pytest.approx((1.0 * 4 + 4 / 5 * 4) / 8)


def test_confusion_counts_are_dense_over_the_classes_of_the_data(spark):
    got = {(r["true"], r["pred"]): r["n"] for r in ev.confusion_counts(counted(spark), "y", "p", "n").collect()}
    assert got == {("a", "a"): 3, ("a", "b"): 1, ("b", "a"): 2, **{k: 0 for k in [("b", "b"), ("a", "c"), ("b", "c"), ("c", "a"), ("c", "b"), ("c", "c")]}}


def test_metrics_document(spark):
    df = spark.createDataFrame([("a", "a", 3), ("a", "b", 1), ("b", "b", 4)], "y string, p string, n long")
    history = spark.createDataFrame([(2, 0.5, 0.8), (1, 0.9, 0.6)], "epoch int, loss double, accuracy double")
    doc = files.metrics_document(df, "y", "p", "n", ev.prf(ev.class_counts(df, "y", "p", "n")), history, F.lit("2024-05-01 10:11:12").cast("timestamp"))
    root = files.scratch_dir(spark, "doc")
    files.sink_metrics(doc, root)
    back = spark.read.json(root).first()
    assert back["class_names"] == ["a", "b"] and back["confusion_matrix"] == [[3, 1], [0, 4]]
    assert back["metrics"]["accuracy"] == 87.5 and back["metrics"]["n_rows"] == 8 and back["timestamp"] == "2024-05-01 10:11:12"
    assert [h["epoch"] for h in back["history"]] == [1, 2] and [c["cls"] for c in back["per_class"]] == ["a", "b"]


def test_wanted_classes_and_absent_folders(spark):
    root = files.scratch_dir(spark, "tree").removeprefix("file:")
    for name in ("cat/1.jpg", "cat/2.JPG", "cat/note.txt", "dog/1.png", "owl/1.jpg"):
        os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
        with open(f"{root}/{name}", "w") as f:
            f.write("xyz")
    got = {r["label"]: (r["n_files"], r["bytes"], r["missing"]) for r in files.labelled_tree_report(spark, root, ["cat", "dog", "fox"], [".jpg"]).collect()}
    assert got == {"cat": (2, 6, False), "dog": (0, 0, True), "fox": (0, 0, True)}
    assert files.scan_labelled_tree(spark, root, [".jpg"], ["owl"]).count() == 1


def test_latest_version_folder_is_the_one_written_last(spark):
    root = files.scratch_dir(spark, "ver").removeprefix("file:")
    schema = T.StructType([T.StructField("a", T.LongType())])
    for name, value in (("z", 1), ("a", 2)):
        spark.range(4).select(F.lit(value).alias("a")).repartition(2).write.json(f"{root}/{name}")
        time.sleep(0.05)
    assert {r["a"] for r in files.latest_version_folder(spark, root, schema).collect()} == {2}
    os.makedirs(f"{root}-empty")
    with pytest.raises(FileNotFoundError):
        files.latest_version_folder(spark, f"{root}-empty", schema)


def test_pairs_of_one_prompt_over_dialogs(spark):
    rows = [("p", 1, 0, "long reply", 10.0), ("p", 2, 0, "s", 1.0), ("p", 3, 0, "tiny", 1.0), ("q", 1, 2, "x", 5.0), ("q", 4, 1, "y", 5.0),
            (None, 1, 1, "a", 1.0), (None, 2, 1, "b", 2.0), ("r", 1, 1, None, 3.0), ("r", 2, 1, "z", 1.0)]
    df = spark.createDataFrame(rows, "prompt string, conv long, turn long, reply string, score double")
    got = rewards.preference_pairs(df, "prompt", "reply", ["conv", "turn"], "score").collect()
    assert [(r["prompt"], r["chosen"], r["rejected"], r["chosen_conv"], r["rejected_conv"]) for r in got] == [
        ("p", "plong reply<|im_end|>", "ps<|im_end|>", 1, 2)]
