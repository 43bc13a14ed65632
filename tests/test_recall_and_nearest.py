"""BM25 recall, exact nearest neighbours over pivot cells, expert maps and context assembly."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import graph as gr, nearest, recall, vectors as vx


def bm25(nodes, query):
    docs = {i: t.lower().split() for i, t in nodes if t and t.split()}
    mean = sum(map(len, docs.values())) / len(docs)
    out = defaultdict(int)
    for token in set(query.lower().split()):
        df = sum(token in d for d in docs.values())
        for i, d in docs.items():
            if tf := Counter(d)[token]:
                idf = math.log(1 + (len(docs) - df + 0.5) / (df + 0.5))
                out[i] += round(idf * (tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / mean))) * 1e6)
    return sorted(((-s, i) for i, s in out.items()))


def test_top_entities_equal_full_scoring_and_spare_frequent_terms(spark):
    rng = random.Random(3)
    words = ["the"] * 40 + ["red", "blue", "ring"] * 3 + [f"w{k}" for k in range(60)]
    nodes = [(f"n{k:03d}", " ".join(rng.choice(words) for _ in range(rng.randrange(1, 9)))) for k in range(300)] + [("e", ""), ("x", None), (None, "red")]
    queries = [(q, " ".join(rng.choice(words) for _ in range(4))) for q in range(25)] + [(90, "nothing here"), (91, None), (92, "The the")]
    df = spark.createDataFrame(nodes, "id string, t string")
    index = recall.text_index(df, "id", F.col("t"), 4)
    q = spark.createDataFrame(queries, "query_id long, text string")
    got = defaultdict(list)
    for r in recall.top_entities(q, index).collect():
        got[r["query_id"]].append((r["rank"], r["entity"], int(r["score"] * 10 ** 6)))
    for i, text in queries:
        want = bm25([n for n in nodes if n[0]], text or "")[:4]
        assert [(e, s) for _, e, s in sorted(got[i])] == [(e, -s) for s, e in want], (i, text)
    assert recall.query_terms(q, index).where("spare").count() > 0
    full = sum(len(bm25([n for n in nodes if n[0]], t or "")) for _, t in queries)
    assert recall.scored_entities(q, index).count() < full  # the floor spared entities


def test_recall_takes_edges_as_they_were_written(spark):
    nodes = spark.createDataFrame([("a", "N", {"name": "Red Ring"}), ("b", "N", {"name": "blue"})], "id string, type string, properties map<string,string>")
    edges = spark.createDataFrame([("a", "R", "b")] * 3 + [("b", "S", "a")], "src string, type string, dst string")
    q = spark.createDataFrame([(1, "ring")], "query_id long, text string")
    got = [tuple(r)[3:] for r in recall.semantic_recall(q, nodes, edges, 5).collect()]
    assert sorted(got) == [("R", "b", "out"), ("S", "b", "in")]


def brute(queries, corpus, k):
    out = []
    for i, g, q in queries:
        d = sorted((sum((a - b) ** 2 for a, b in zip(q, v)), c) for c, h, v in corpus if h != g)[:k]
        out += [(i, r + 1, c, round(x, 6)) for r, (x, c) in enumerate(d)]
    return sorted(out)


def test_nearest_equals_brute_force_with_groups_ties_and_odd_rows(spark):
    rng = random.Random(5)
    centres = [[rng.gauss(0, 5) for _ in range(6)] for _ in range(8)]
    rows = [(i, i // 3, [x + rng.gauss(0, 0.3) for x in rng.choice(centres)]) for i in range(240)]
    rows += [(300 + i, 300 + i, rows[0][2]) for i in range(40)]  # many copies of one vector
    odd = [(400, 400, None), (401, 401, [float("nan")] * 6), (None, 1, [0.0] * 6), (402, 402, [None] * 6)]
    df = spark.createDataFrame(rows + odd, "id long, g long, v array<double>").repartition(3)
    got = nearest.knn_join(df, df, "id", "id", "v", 4, group="g", pivots=8, block=16)
    assert sorted((a, b, c, round(d, 6)) for a, b, c, d in got.collect()) == brute(rows, rows, 4)
    few = nearest.knn_join(df.where("id < 5"), df.where("id < 4"), "id", "id", "v", 9, pivots=8)
    assert sorted((a, b, c, round(d, 6)) for a, b, c, d in few.collect()) == brute([(i, i, v) for i, _, v in rows[:5]], [(i, i, v) for i, _, v in rows[:4]], 9)
    assert nearest.knn_join(df.limit(0), df.limit(0), "id", "id", "v", 2).count() == 0


def test_clustered_vectors_visit_few_cells(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 10, (32, 16))
    x = centres[rng.integers(0, 32, 1500)] + rng.normal(0, 0.2, (1500, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    r = nearest.visited_share(df, df, "id", "id", "v", 2, pivots=32).first()
    assert r["visited"] < 0.25 * r["possible"]


def test_expert_outputs_meet_per_row(spark):
    e = spark.createDataFrame([(0, [[1.0, 0.0], [0.0, 2.0]]), (1, [[0.0, 1.0], [1.0, 0.0]])], "expert int, matrix array<array<double>>")
    rows = [(1, [1.0, 3.0], [(0, 0.25), (1, 0.75)]), (1, [2.0, 0.0], [(0, 1.0)]), (None, [1.0, 1.0], [(1, 1.0), (7, 1.0)]), (4, [1.0, 1.0], [(7, 1.0)]), (5, [1.0, 1.0], [])]
    df = spark.createDataFrame(rows, "id long, x array<double>, routes array<struct<expert: int, weight: double>>")
    got = sorted((r["id"] or 0, r["output"]) for r in vx.expert_combine(df, "id", "x", e).collect() if r["output"])
    assert got == [(0, [1.0, 1.0]), (1, [2.0, 0.0]), (1, [0.25 + 2.25, 1.5 + 0.75])]
    assert vx.expert_combine(df, "id", "x", e).count() == 5


def test_budget_ends_a_list_at_the_first_item_that_does_not_fit(spark):
    items = spark.createDataFrame([(1, 1, "abcd"), (1, 2, "efghij"), (1, 3, "k"), (2, 1, "longer than ten")], "q long, r int, t string")
    assert {r["q"]: r["texts"] for r in gr.within_budget(items, "q", ["r"], "t", 10).collect()} == {1: "abcd"}
    q = spark.createDataFrame([(1,), (2,), (2,)], "q long")
    e = gr.within_budget(items, "q", ["r"], "t", 10)
    ctx = {r["q"]: r["context"] for r in gr.context_assembly(q, e, e.limit(0), "q").collect()}
    assert ctx == {1: "Episodic memory:\nabcd\n\nSemantic memory:\n(none)", 2: "Episodic memory:\n(none)\n\nSemantic memory:\n(none)"}


def test_frequent_words_hand_on_few_rows_a_query_whatever_the_blocks(spark, monkeypatch):
    rng = random.Random(8)
    nodes = [(f"s{k:03d}", f"only{k}") for k in range(60)]
    nodes += [(f"p{k:03d}", " ".join(["red", "ring", "gold"][:1 + k % 3] + [rng.choice("uvw")] * (k % 5))) for k in range(300)]
    queries = [(k, f"has only{k} the red ring of gold") for k in range(60)]
    df, q = spark.createDataFrame(nodes, "id string, t string"), spark.createDataFrame(queries, "query_id long, text string")
    index = recall.text_index(df, "id", F.col("t"), 3)
    want = {(i, r + 1, e, s) for i, text in queries for r, (s, e) in enumerate(bm25(nodes, text)[:3])}
    for postings, asked in ((100_000, 1024), (40, 7)):
        monkeypatch.setattr(recall, "BLOCK_POSTINGS", postings)
        monkeypatch.setattr(recall, "BLOCK_QUERIES", asked)
        got = {(r["query_id"], r["rank"], r["entity"], -int(r["score"] * 10 ** 6)) for r in recall.top_entities(q, index).collect()}
        assert got == want
        assert recall.scored_entities(q, index).count() <= 60 * 3 * 3  # not a row per query and posting


def test_entities_of_the_same_words_count_but_are_scored_once(spark):
    nodes = [(f"n{k:02d}", "ring red" if k % 2 else "red ring") for k in range(40)] + [("m", "red red ring"), ("z", "blue")]
    index = recall.text_index(spark.createDataFrame(nodes, "id string, t string"), "id", F.col("t"), 4)
    assert index.postings.where("token = 'red'").count() == 2
    assert index.terms.where("token = 'red'").first()["df"] == 41
    got = [(r["entity"], -int(r["score"] * 10 ** 6)) for r in recall.top_entities(spark.createDataFrame([(1, "red ring")], "query_id long, text string"), index).orderBy("rank").collect()]
    assert got == [(e, s) for s, e in bm25(nodes, "red ring")[:4]]


def test_evenly_spread_vectors_and_copies_hand_on_k_rows_a_cell(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(600, 8)), np.repeat(rng.normal(size=(1, 8)), 200, axis=0), 1e6 + 1e-4 * rng.normal(size=(40, 8))])
    rows = [(int(i), int(i) // 2, v.tolist()) for i, v in zip(rng.permutation(len(x)), x)]
    df = spark.createDataFrame(rows, "id long, g long, v array<double>").repartition(3)
    q = nearest.prepared(df, "id", "v", "g")
    going, cells, _ = nearest.plan_visits(q, q, 3, 4, 16)
    assert cells.agg(F.max(F.size("ids"))).first()[0] == 16
    assert nearest.compared(nearest.met(going, cells), 3).count() <= len(rows) * 3 * 4  # k a block before, now k a cell
    want = []
    for i, g, v in rows:  # sums as the operator adds them, so that ties are ties
        d = ((np.array(v) - np.array([r[2] for r in rows])) ** 2).sum(axis=1)
        near = sorted((e, j) for e, (j, h, _) in zip(d.tolist(), rows) if h != g)[:3]
        want += [(i, r + 1, j, e) for r, (e, j) in enumerate(near)]
    got = nearest.knn_join(df, df, "id", "id", "v", 3, group="g", pivots=4, block=16)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
