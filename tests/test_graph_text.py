"""Graph, memory and text-extraction operators on literal rows."""

from tessera.operators import graph as gr
from tessera.operators import text


def _graph(spark):
    nodes = spark.createDataFrame(
        [("r:0", "Region", {"name": "ASIA"}), ("n:1", "Nation", {"name": "JAPAN"}),
         ("c:1", "Customer", {"name": "Ann", "segment": "A"}), ("p:1", "Part", {"name": "red bolt"})],
        "id string, type string, properties map<string,string>")
    edges = spark.createDataFrame(
        [("n:1", "IN", "r:0", {}, 1), ("c:1", "FROM", "n:1", {}, 1),
         ("c:1", "ORDERED", "p:1", {"q": "1"}, 1), ("c:1", "ORDERED", "p:1", {"q": "5"}, 2)],
        "src string, type string, dst string, properties map<string,string>, v int")
    return nodes, edges


def test_dedup_graph_latest_properties_win(spark):
    _, edges = _graph(spark)
    merged = gr.dedup_graph(edges, ["v"])
    rows = {(r["src"], r["type"], r["dst"]): r["properties"] for r in merged.collect()}
    assert len(rows) == 3 and rows[("c:1", "ORDERED", "p:1")] == {"q": "5"}


def test_neighbors_both_directions_and_typed_match(spark):
    nodes, edges = _graph(spark)
    e = gr.dedup_graph(edges, ["v"]).drop("v")
    seeds = spark.createDataFrame([("n:1",)], "id string")
    nb = sorted((r["relation"], r["neighbor"], r["direction"]) for r in gr.graph_neighbors(seeds, e).collect())
    assert nb == [("FROM", "c:1", "in"), ("IN", "r:0", "out")]
    m = sorted(tuple(r) for r in gr.graph_typed_match(nodes, e, "Customer", ["ORDERED"]).collect())
    assert m == [("c:1", "ORDERED", "p:1", "Part")]


def test_graph_schema_keys(spark):
    nodes, edges = _graph(spark)
    s = {(r["kind"], r["type"]): r["property_keys"] for r in gr.graph_schema(nodes, edges.drop("v")).collect()}
    assert s[("node", "Customer")] == "name,segment" and s[("edge", "ORDERED")] == "q" and s[("edge", "IN")] == ""


def test_semantic_recall_token_match_and_limit_per_query(spark):
    nodes, edges = _graph(spark)
    e = gr.dedup_graph(edges, ["v"]).drop("v")
    q = spark.createDataFrame([(1, "Where is  Japan ?"), (2, "bolt")], "query_id long, text string")
    out = [(r["query_id"], r["entity"], r["neighbor"]) for r in gr.semantic_recall(q, nodes, e, limit=2).collect()]
    assert sorted(out) == [(1, "n:1", "c:1"), (1, "n:1", "r:0"), (2, "p:1", "c:1")]


def test_extract_json_pair_reasons(spark):
    df = spark.createDataFrame([("x {\"instruction\": \" a \", \"output\": \"b\"} y",), ("no braces",),
                                ("{\"instruction\": \"a\", \"output\": }",), ("{\"instruction\": \"a\", \"output\": \"  \"}",)],
                               "t string")
    out = [(r["instruction"], r["output"], r["reason"]) for r in text.extract_json_pair(df, "t").collect()]
    assert out == [("a", "b", None), (None, None, "no_json"), (None, None, "bad_json"), ("a", "", "empty_field")]


def test_parse_tool_call_fallback(spark):
    df = spark.createDataFrame([("web_search('a b')",), ('calc("1+1")',), ("web_search(a b)",)], "s string")
    out = [(r["tool"], r["query"]) for r in text.parse_tool_call(df, "s").collect()]
    assert out == [("web_search", "a b"), ("calc", "1+1"), ("web_search", "web_search(a b)")]


def test_validate_struct_ranges(spark):
    df = spark.createDataFrame([('{"k": 3}',), ('{"k": 11}',), ('{"j": 1}',), ("oops",)], "s string")
    out = [(r["k"], r["is_valid"], r["reason"]) for r in text.validate_struct(df, "s", "k int", {"k": (1, 10)}).collect()]
    assert out == [(3, True, None), (11, False, "k:range"), (None, False, "k:missing"), (None, False, "k:missing")]


def test_path_search_no_route(spark):
    e = spark.createDataFrame([("a", "b")], "src string, dst string")
    assert gr.path_search(e, "a", "z").count() == 0
