"""Plug-in hooks and their contract; sampling by a cut value; two-sided path search."""

import hashlib
import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from tessera.operators import paths, plugins
from tessera.operators.sampling import sample_n


def test_rewards_skip_nulls_and_add_up(spark):
    df = spark.createDataFrame([("p", "abc"), (None, "x"), ("q", None), ("r", "")], "p string, c string")
    both = lambda p, c: [len(a) + len(b) for a, b in zip(p, c)]
    out = plugins.with_user_rewards(df, {"n": (both, {"p": F.col("p"), "c": F.col("c")}), "k": (lambda c: [1] * len(c), {"c": F.col("c")})}, {"n": 2.0, "k": 1.0})
    assert [(r["n"], r["k"], r["reward"]) for r in out.collect()] == [(4.0, 1.0, 9.0), (None, 1.0, None), (None, None, None), (1.0, 1.0, 3.0)]
    seen = df.select(plugins.user_reward(lambda c: [0.0 if x is None else 1.0 for x in c], {"c": F.col("c")}, needs=()).alias("r"))
    assert [r["r"] for r in seen.collect()] == [1.0, 1.0, 0.0, 1.0]


@pytest.mark.parametrize("fn", [lambda c: [1.0], lambda c: [float("nan")] * len(c), lambda c: ["x"] * len(c), lambda c: None])
def test_a_broken_contract_ends_the_job(spark, fn):
    df = spark.createDataFrame([("a",), ("b",)], "c string").coalesce(1)
    with pytest.raises(Exception, match="PluginError"):
        df.select(plugins.user_reward(fn, {"c": F.col("c")})).collect()
    with pytest.raises(plugins.PluginError):
        plugins.user_reward(fn, {"c": F.col("c")}, needs=["d"])


def test_tokenizer_and_collate(spark):
    df = spark.createDataFrame([(0, "ab", 0), (1, None, 0), (2, "", 1)], "i int, t string, b int")
    ids = df.select("i", "b", plugins.user_tokenizer(lambda ts: [[ord(c) for c in t] for t in ts], F.col("t")).alias("ids"))
    assert [r["ids"] for r in ids.orderBy("i").collect()] == [[97, 98], None, []]
    pad = lambda rows: [{"b": r["b"], "i": r["i"], "width": max(len(x["ids"] or []) for x in rows)} for r in rows]
    got = plugins.user_collate(ids, "b", pad, "b int, i int, width int").collect()
    assert sorted((r["b"], r["i"], r["width"]) for r in got) == [(0, 0, 2), (0, 1, 2), (1, 2, 0)]


@pytest.mark.parametrize("n", [0, 1, 33, 100, 120, 500])
def test_sample_equals_the_first_n_by_hash(spark, n):
    rows = [(i,) for i in range(100)] + [(7,)] * 20
    got = sorted(r["id"] for r in sample_n(spark.createDataFrame(rows, "id long"), "id", n).collect())
    want = sorted(i for _, i in sorted((hashlib.md5(f"{i}42".encode()).hexdigest(), i) for (i,) in rows)[:n])
    assert got == want


def test_sample_of_a_third_puts_no_third_into_one_task(spark):
    plan = sample_n(spark.range(9000), "id", 3000)._jdf.queryExecution().toString()
    assert "Limit" not in plan


def brute(edges, start, goal):
    nxt = {}
    for a, b in edges:
        if a and b:
            nxt.setdefault(a, set()).add(b)
    todo, found = deque([[start]]), []
    while todo:
        p = todo.popleft()
        if found and len(p) > len(found[0]):
            break
        if p[-1] == goal:
            found.append(p)
            continue
        todo.extend([*p, b] for b in nxt.get(p[-1], ()) if b not in p)
    return sorted(found)


def test_paths_and_counts_on_random_graphs(spark):
    for seed in range(4):
        rng = random.Random(seed)
        edges = [(f"s{rng.randrange(14)}", f"s{rng.randrange(14)}") for _ in range(30)] + [("s1", None), (None, "s2"), ("s1", "s1")]
        df = spark.createDataFrame(edges * 2, "src string, dst string")
        want = brute(edges, "s0", "s9")
        got = sorted((r["path"], r["depth"]) for r in paths.path_search(df, "s0", "s9").collect())
        assert got == [(p, len(p) - 1) for p in want]
        counts = [(r["depth"], int(r["n_paths"])) for r in paths.path_counts(df, "s0", "s9").collect()]
        assert counts == ([(len(want[0]) - 1, len(want))] if want else [])
    assert [r["path"] for r in paths.path_search(df, "s3", "s3").collect()] == [["s3"]]
