"""Graph and memory queries over the TPC-H-like tables (fixture F7) and traces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import WS_CLASS
from tessera.operators import graph as gr
from tessera.operators import vectors as vx
from tessera.operators.chat import episodic_rows
from tessera.operators.graph import node_id
from tessera.operators.nearest import knn_join
from tessera.operators.ordering import settled, with_global_index
from tessera.operators.paths import path_counts, path_search
from tessera.operators.recall import B, K1, PLACES, both_ends, keyword_tokens, semantic_recall
from tessera.plans.q_trace import indexed_trace
from tessera.plans.registry import register
from tessera.plans.sqlkit import PAIRS_CTE
from tessera.sources.tables import table

# Segment names mapped for J1; MACHINERY is left out on purpose.
SEGMENT_MAP = [("AUTOMOBILE", "cars"), ("BUILDING", "construction"), ("FURNITURE", "home"),
               ("HOUSEHOLD", "household goods")]


def nodes(spark, sf) -> DataFrame:
    T = lambda n: table(spark, sf, n)
    m = F.create_map
    parts = [
        T("region").select(node_id("region", F.col("r_regionkey")).alias("id"), F.lit("Region").alias("type"),
                           m(F.lit("name"), F.col("r_name")).alias("properties")),
        T("nation").select(node_id("nation", F.col("n_nationkey")).alias("id"), F.lit("Nation").alias("type"),
                           m(F.lit("name"), F.col("n_name")).alias("properties")),
        T("customer").select(node_id("customer", F.col("c_custkey")).alias("id"), F.lit("Customer").alias("type"),
                             m(F.lit("name"), F.col("c_name"), F.lit("segment"), F.col("c_mktsegment")).alias("properties")),
        T("supplier").select(node_id("supplier", F.col("s_suppkey")).alias("id"), F.lit("Supplier").alias("type"),
                             m(F.lit("name"), F.col("s_name")).alias("properties")),
        T("part").select(node_id("part", F.col("p_partkey")).alias("id"), F.lit("Part").alias("type"),
                         m(F.lit("name"), F.col("p_name"), F.lit("brand"), F.col("p_brand")).alias("properties")),
    ]
    return gr.union_all(parts)


def raw_edges(spark, sf) -> DataFrame:
    """M2 over every source table; ORDERED edges keep their order line as version
    (order date, order, line, quantity - the last breaks ties between repeated lines)."""
    T = lambda n: table(spark, sf, n)
    nv = lambda: F.lit(None).cast("timestamp").alias("v_date")
    nk = lambda: F.lit(None).cast("bigint").alias("v_key")
    nl = lambda: F.lit(None).cast("int").alias("v_line")
    nq = lambda: F.lit(None).cast("double").alias("v_qty")
    nat = gr.extract_triples(T("nation"), [(node_id("nation", F.col("n_nationkey")), "IN",
                                            node_id("region", F.col("n_regionkey")))])
    cus = gr.extract_triples(T("customer"), [
        (node_id("customer", F.col("c_custkey")), "FROM", node_id("nation", F.col("c_nationkey"))),
        (node_id("customer", F.col("c_custkey")), "IN_SEGMENT", F.concat(F.lit("segment:"), F.col("c_mktsegment")))])
    sup = gr.extract_triples(T("supplier"), [(node_id("supplier", F.col("s_suppkey")), "FROM",
                                              node_id("nation", F.col("s_nationkey")))])
    static = gr.union_all([nat, cus, sup]).select("*", nv(), nk(), nl(), nq())
    li = T("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    od = T("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    ol = li.join(od, li["l_orderkey"] == od["o_orderkey"])
    props = F.create_map(F.lit("orderkey"), F.col("l_orderkey").cast("string"),
                         F.lit("quantity"), F.floor("l_quantity").cast("bigint").cast("string"))
    ordered = ol.select(node_id("customer", F.col("o_custkey")).alias("src"), F.lit("ORDERED").alias("type"),
                        node_id("part", F.col("l_partkey")).alias("dst"), props.alias("properties"),
                        F.col("o_orderdate").alias("v_date"), F.col("l_orderkey").alias("v_key"),
                        F.col("l_linenumber").alias("v_line"), F.col("l_quantity").alias("v_qty"))
    return static.unionByName(ordered)


def edges(spark, sf) -> DataFrame:
    """D3-merged edge table."""
    return gr.dedup_graph(raw_edges(spark, sf), ["v_date", "v_key", "v_line", "v_qty"]).select("src", "type", "dst", "properties")


NODES_SQL = """
nodes AS (
  SELECT 'region:' || r_regionkey AS id, 'Region' AS type, r_name AS name FROM region
  UNION ALL SELECT 'nation:' || n_nationkey, 'Nation', n_name FROM nation
  UNION ALL SELECT 'customer:' || c_custkey, 'Customer', c_name FROM customer
  UNION ALL SELECT 'supplier:' || s_suppkey, 'Supplier', s_name FROM supplier
  UNION ALL SELECT 'part:' || p_partkey, 'Part', p_name FROM part)
"""
STATIC_EDGES_SQL = """
static_edges AS (
  SELECT 'nation:' || n_nationkey AS src, 'IN' AS type, 'region:' || n_regionkey AS dst FROM nation
  UNION ALL SELECT 'customer:' || c_custkey, 'FROM', 'nation:' || c_nationkey FROM customer
  UNION ALL SELECT 'customer:' || c_custkey, 'IN_SEGMENT', 'segment:' || c_mktsegment FROM customer
  UNION ALL SELECT 'supplier:' || s_suppkey, 'FROM', 'nation:' || s_nationkey FROM supplier)
"""
ORDERED_SQL = """
ordered AS (
  SELECT 'customer:' || o_custkey AS src, 'ORDERED' AS type, 'part:' || l_partkey AS dst,
         l_orderkey, CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) AS quantity, o_orderdate, l_linenumber, l_quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""
EDGES_SQL = STATIC_EDGES_SQL + "," + ORDERED_SQL + """,
merged AS (
  SELECT src, type, dst, l_orderkey, quantity FROM (
    SELECT *, row_number() OVER (PARTITION BY src, type, dst ORDER BY o_orderdate DESC, l_orderkey DESC, l_linenumber DESC, l_quantity DESC) AS rn
    FROM ordered) WHERE rn = 1),
edges AS (SELECT src, type, dst FROM static_edges UNION ALL SELECT src, type, dst FROM merged)
"""


@register("m2_extract_triples", "WITH " + STATIC_EDGES_SQL + "," + ORDERED_SQL + """
SELECT src, type, dst FROM static_edges UNION ALL SELECT src, type, dst FROM ordered
""")
def m2(spark, sf):
    return raw_edges(spark, sf).select("src", "type", "dst")


@register("d3_dedup_graph", "WITH " + EDGES_SQL + """
SELECT src, type, dst, CAST(l_orderkey AS VARCHAR) AS last_orderkey, quantity AS last_quantity FROM merged
UNION ALL SELECT src, type, dst, NULL, NULL FROM static_edges
""")
def d3(spark, sf):
    e = edges(spark, sf)
    return e.select("src", "type", "dst", F.col("properties")["orderkey"].alias("last_orderkey"),
                    F.col("properties")["quantity"].alias("last_quantity"))


@register("g13_graph_schema", "WITH " + EDGES_SQL + """
SELECT 'node' AS kind, 'Region' AS type, 'name' AS property_keys, count(*) AS n FROM region
UNION ALL SELECT 'node', 'Nation', 'name', count(*) FROM nation
UNION ALL SELECT 'node', 'Customer', 'name,segment', count(*) FROM customer
UNION ALL SELECT 'node', 'Supplier', 'name', count(*) FROM supplier
UNION ALL SELECT 'node', 'Part', 'brand,name', count(*) FROM part
UNION ALL SELECT 'edge', type, CASE WHEN type = 'ORDERED' THEN 'orderkey,quantity' ELSE '' END, count(*) FROM edges GROUP BY type
""")
def g13(spark, sf):
    return gr.graph_schema(nodes(spark, sf), edges(spark, sf))


def region_seeds(spark, sf) -> DataFrame:
    return table(spark, sf, "region").select(node_id("region", F.col("r_regionkey")).alias("id"))


NEIGHBORS_SQL = "WITH " + EDGES_SQL + """,
both_dir AS (SELECT src, type, dst, 'out' AS direction FROM edges UNION ALL SELECT dst, type, src, 'in' FROM edges),
nb AS (SELECT b.src AS entity, b.type AS relation, b.dst AS neighbor, b.direction
       FROM (SELECT DISTINCT 'region:' || r_regionkey AS id FROM region) s JOIN both_dir b ON b.src = s.id)
"""


@register("j6_graph_neighbors", NEIGHBORS_SQL + " SELECT entity, relation, neighbor, direction FROM nb")
def j6(spark, sf):
    return gr.graph_neighbors(region_seeds(spark, sf), raw_edges(spark, sf))


@register("w11_limit_global", NEIGHBORS_SQL + " SELECT entity, relation, neighbor, direction FROM nb ORDER BY entity, relation, neighbor, direction LIMIT 5")
def w11(spark, sf):
    nb = gr.graph_neighbors(region_seeds(spark, sf), raw_edges(spark, sf))
    return gr.limit_global(nb, ["entity", "relation", "neighbor", "direction"], 5)


@register("j7_graph_typed_match", "WITH " + NODES_SQL + "," + EDGES_SQL + """
SELECT e.src, e.type AS relation, e.dst, m.type AS dst_type
FROM (SELECT id FROM nodes WHERE type = 'Customer') n JOIN edges e ON e.src = n.id AND e.type IN ('FROM', 'ORDERED')
JOIN nodes m ON m.id = e.dst
""")
def j7(spark, sf):
    return gr.graph_typed_match(nodes(spark, sf), edges(spark, sf), "Customer", ["FROM", "ORDERED"])


@register("j1_rename_classes", f"""
WITH m(from_name, to_name) AS (VALUES {", ".join(f"('{a}', '{b}')" for a, b in SEGMENT_MAP)})
SELECT c_custkey, c_mktsegment, m.to_name AS segment_label FROM customer JOIN m ON m.from_name = c_mktsegment
""")
def j1(spark, sf):
    mp = spark.createDataFrame(SEGMENT_MAP, "from_name string, to_name string")
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return gr.rename_classes(c, "c_mktsegment", mp, "segment_label")


def region_questions(spark, sf) -> DataFrame:
    """One question per region, asked in words."""
    return table(spark, sf, "region").select(F.concat(F.lit("region:"), F.col("r_regionkey")).alias("query_id"),
                                             F.concat(F.lit("Which nations are in "), F.col("r_name"), F.lit(" ?")).alias("text"))


def supplier_questions(spark, sf) -> DataFrame:
    """One question per supplier about the part whose key is the supplier's; every word of it stands in many nodes."""
    s, p = table(spark, sf, "supplier").select("s_suppkey", "s_name"), table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    return s.join(p, s["s_suppkey"] == p["p_partkey"]).select(
        F.concat(F.lit("supplier:"), F.col("s_suppkey")).alias("query_id"),
        F.concat(F.lit("Does "), F.col("s_name"), F.lit(" sell the "), F.col("p_name"), F.lit(" of "), F.col("p_brand"), F.lit(" ?")).alias("text"))


NODE_TEXT_SQL = """
node_text AS (
  SELECT 'region:' || r_regionkey AS entity, r_name AS text FROM region
  UNION ALL SELECT 'nation:' || n_nationkey, n_name FROM nation
  UNION ALL SELECT 'customer:' || c_custkey, c_name || ' ' || c_mktsegment FROM customer
  UNION ALL SELECT 'supplier:' || s_suppkey, s_name FROM supplier
  UNION ALL SELECT 'part:' || p_partkey, p_name || ' ' || p_brand FROM part)
"""


def bm25_sql(queries: str) -> str:
    """CTEs that score every entity for the rows of ``queries`` (query_id, text): ``scored`` and the five best, ``best``."""
    words = lambda x: f"list_filter(regexp_split_to_array(lower({x}), '{WS_CLASS}+'), lambda x: x <> '')"
    return f"""
posting AS (SELECT token, entity, count(*) AS tf FROM (SELECT entity, unnest({words('text')}) AS token FROM node_text) GROUP BY 1, 2),
len AS (SELECT entity, sum(tf) AS length FROM posting GROUP BY 1),
whole AS (SELECT count(*) AS n, avg(length) AS mean FROM len),
term AS (SELECT token, ln(1 + (n - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM posting, whole GROUP BY token, n),
kw AS (SELECT DISTINCT query_id, unnest({words('text')}) AS token FROM {queries}),
part_score AS (
  SELECT query_id, entity, CAST(round(idf * (CAST(tf AS DOUBLE) * {K1 + 1} / (tf + {K1} * (1 - {B} + {B} * length / mean))), {PLACES}) AS DECIMAL(18, {PLACES})) AS part
  FROM kw JOIN term USING (token) JOIN posting USING (token) JOIN len USING (entity), whole),
scored AS (SELECT query_id, entity, sum(part) AS score FROM part_score GROUP BY 1, 2),
best AS (SELECT query_id, entity, score FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, entity) <= 5),
both_dir AS (SELECT src, type, dst, 'out' AS direction FROM edges UNION ALL SELECT dst, type, src, 'in' FROM edges),
recalled AS (
  SELECT h.query_id, h.entity, h.score, b.type AS relation, b.dst AS neighbor, b.direction,
         row_number() OVER (PARTITION BY h.query_id ORDER BY h.score DESC, h.entity, b.type, b.dst, b.direction) AS rn
  FROM best h JOIN both_dir b ON b.src = h.entity QUALIFY rn <= 5)
"""


RECALLED_SQL = bm25_sql("q") + " SELECT query_id, entity, CAST(score AS DOUBLE) AS score, relation, neighbor, direction FROM recalled"


def recalled(spark, sf, questions: DataFrame) -> DataFrame:
    rows = semantic_recall(questions, nodes(spark, sf), raw_edges(spark, sf), 5)
    return rows.withColumn("score", F.col("score").cast("double"))


@register("m3_semantic_recall", "WITH " + NODE_TEXT_SQL + "," + EDGES_SQL + """,
q AS (SELECT 'region:' || r_regionkey AS query_id, 'Which nations are in ' || r_name || ' ?' AS text FROM region),
""" + RECALLED_SQL)
def m3(spark, sf):
    return recalled(spark, sf, region_questions(spark, sf))


@register("m3_supplier_questions", "WITH " + NODE_TEXT_SQL + "," + EDGES_SQL + """,
q AS (SELECT 'supplier:' || s_suppkey AS query_id, 'Does ' || s_name || ' sell the ' || p_name || ' of ' || p_brand || ' ?' AS text
      FROM supplier JOIN part ON p_partkey = s_suppkey),
""" + RECALLED_SQL)
def m3_suppliers(spark, sf):
    return recalled(spark, sf, supplier_questions(spark, sf))


@register("x1_path_search", """
WITH RECURSIVE tr AS (
  SELECT event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
e AS (SELECT DISTINCT prev AS src, event_type AS dst FROM tr WHERE prev IS NOT NULL),
p(path, last, depth) AS (
  SELECT ['view'], 'view', 0
  UNION ALL
  SELECT list_append(p.path, e.dst), e.dst, p.depth + 1 FROM p JOIN e ON e.src = p.last
  WHERE NOT list_contains(p.path, e.dst) AND p.last <> 'purchase')
SELECT array_to_string(path, '>') AS path, CAST(depth AS INTEGER) AS depth FROM p
WHERE last = 'purchase' AND depth = (SELECT min(depth) FROM p WHERE last = 'purchase')
""")
def x1(spark, sf):
    t = indexed_trace(spark, sf)
    from tessera.operators.ordering import neighbour
    j = neighbour(t, ["user_id"], ["event_type"], 1, prefix="prev_").where(F.col("prev_event_type").isNotNull())
    e = j.select(F.col("prev_event_type").alias("src"), F.col("event_type").alias("dst"))
    p = path_search(e, "view", "purchase")
    return p.select(F.array_join("path", ">").alias("path"), F.col("depth").cast("int").alias("depth"))


EPISODIC_CHARS, SEMANTIC_CHARS, DIMS = 1500, 300, 64


def session_queries(spark, sf) -> DataFrame:
    """(query_id, text): the last user turn of each dialog, after the name of the customer with the dialog's number."""
    turns = table(spark, sf, "conversations").where(F.col("role") == "user")
    last = turns.groupBy("conv_id").agg(F.max_by("text", "turn").alias("asked"))
    who = table(spark, sf, "customer").select("c_custkey", "c_name")
    return last.join(who, last["conv_id"] == who["c_custkey"], "left").select(
        F.col("conv_id").alias("query_id"), F.concat_ws(" ", "c_name", "asked").alias("text"))


def term_vector_sql(name: str, rows: str) -> str:
    """CTEs ``name`` (id, b, c) with the integer components other than 0 of the rows (id, text) and ``name``_norm."""
    return f"""
{name}_tok AS (SELECT id, unnest(list_filter(regexp_split_to_array(lower(text), '{WS_CLASS}+'), lambda x: x <> '')) AS t FROM {rows}),
{name}_sum AS (SELECT id, CAST('0x' || substr(md5(t), 1, 8) AS BIGINT) % {DIMS} AS b, sum(CASE WHEN substr(md5(t), 9, 1) >= '8' THEN -1 ELSE 1 END) AS s FROM {name}_tok GROUP BY 1, 2),
{name} AS (SELECT id, b, CAST(floor(CAST(s AS DOUBLE) * 1000.0 / n + 0.5) AS BIGINT) AS c
           FROM {name}_sum JOIN (SELECT id, sqrt(CAST(sum(s * s) AS DOUBLE)) AS n FROM {name}_sum GROUP BY 1) USING (id) WHERE n > 0),
{name}_norm AS (SELECT r.id, coalesce(sum(c * c), 0) AS nn FROM {rows} r LEFT JOIN {name} USING (id) GROUP BY 1)"""


FIRST_REGION, SECOND_REGION = "region:0", "region:1"


def level_counts_sql(levels: int) -> str:
    """CTEs l0, l1, ...: states first reached at each depth with the number of shortest paths to them."""
    out = [f"l0 AS (SELECT '{FIRST_REGION}' AS state, CAST(1 AS HUGEINT) AS n)"]
    for k in range(1, levels + 1):
        seen = " UNION ALL ".join(f"SELECT state FROM l{j}" for j in range(k))
        out.append(f"l{k} AS (SELECT b.dst AS state, sum(l.n) AS n FROM l{k - 1} l JOIN step b ON b.src = l.state "
                   f"WHERE b.dst NOT IN ({seen}) GROUP BY b.dst)")
    found = " UNION ALL ".join(f"SELECT {k} AS depth, n FROM l{k} WHERE state = '{SECOND_REGION}'" for k in range(levels + 1))
    return ",\n".join(out) + f" SELECT CAST(depth AS INTEGER) AS depth, CAST(n AS DOUBLE) AS n_paths FROM ({found})"


@register("x1_path_counts", "WITH " + EDGES_SQL + """,
step AS (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges),
""" + level_counts_sql(8))
def x1_counts(spark, sf):
    """Shortest ways between two regions over relations of either direction (nations, customers, parts between them)."""
    both = both_ends(raw_edges(spark, sf)).select(F.col("entity").alias("src"), F.col("neighbor").alias("dst"))
    return path_counts(both, FIRST_REGION, SECOND_REGION).select("depth", F.col("n_paths").cast("double").alias("n_paths"))


@register("c11_context_assembly", "WITH " + NODE_TEXT_SQL + "," + EDGES_SQL + "," + PAIRS_CTE + """,
mem AS (SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS id, conv_id, 'User: ' || question || chr(10) || 'Assistant: ' || answer AS text FROM pairs),
q AS (SELECT conv_id AS query_id, conv_id AS id, CASE WHEN c_name IS NULL THEN asked ELSE c_name || ' ' || asked END AS text
      FROM (SELECT conv_id, max_by(text, turn) AS asked FROM conversations WHERE role = 'user' GROUP BY 1) LEFT JOIN customer ON c_custkey = conv_id),
""" + term_vector_sql("qv", "q") + "," + term_vector_sql("mv", "mem") + """,
dots AS (SELECT qv.id AS qid, mv.id AS mid, sum(qv.c * mv.c) AS d FROM qv JOIN mv USING (b) GROUP BY 1, 2),
near AS (SELECT qn.id AS query_id, mem.text, row_number() OVER (PARTITION BY qn.id ORDER BY qn.nn + mn.nn - 2 * coalesce(d, 0), mem.id) AS rank
         FROM qv_norm qn JOIN mem ON mem.conv_id <> qn.id JOIN mv_norm mn ON mn.id = mem.id LEFT JOIN dots ON qid = qn.id AND mid = mem.id
         QUALIFY rank <= 2),
ep AS (SELECT query_id, string_agg(text, chr(10) ORDER BY rank) AS texts FROM (
         SELECT *, sum(length(text) + 1) OVER (PARTITION BY query_id ORDER BY rank) - 1 AS used FROM near) WHERE used <= """ + str(EPISODIC_CHARS) + """ GROUP BY 1),
""" + bm25_sql("q") + """,
fact AS (SELECT query_id, rn, entity || CASE WHEN direction = 'out' THEN ' -' || relation || '-> ' ELSE ' <-' || relation || '- ' END || neighbor AS text FROM recalled),
sem AS (SELECT query_id, string_agg(text, chr(10) ORDER BY rn) AS texts FROM (
         SELECT *, sum(length(text) + 1) OVER (PARTITION BY query_id ORDER BY rn) - 1 AS used FROM fact) WHERE used <= """ + str(SEMANTIC_CHARS) + """ GROUP BY 1)
SELECT q.query_id, 'Episodic memory:' || chr(10) || coalesce(ep.texts, '(none)') || chr(10) || chr(10) || 'Semantic memory:' || chr(10) || coalesce(sem.texts, '(none)') AS context
FROM q LEFT JOIN ep USING (query_id) LEFT JOIN sem USING (query_id)
""")
def c11(spark, sf):
    asked = settled(session_queries(spark, sf))
    memories = episodic_rows(table(spark, sf, "conversations"))
    memories = settled(with_global_index(memories, [F.col("conv_id"), F.col("turn")], "id"))
    vectors = lambda df, key, text: vx.hashed_terms(df, key, keyword_tokens(F.col(text)), DIMS)
    corpus = vectors(memories, "id", "memory").join(memories.select("id", "conv_id"), "id")
    queries = vectors(asked, "query_id", "text").withColumn("conv_id", F.col("id"))
    near = knn_join(queries, corpus, "id", "id", "vector", 2, group="conv_id")
    recalled = near.join(memories.select(F.col("id").alias("neighbor_id"), "memory"), "neighbor_id")
    episodic = gr.within_budget(recalled, "query_id", ["rank"], "memory", EPISODIC_CHARS)
    facts = semantic_recall(asked, nodes(spark, sf), raw_edges(spark, sf), 5)
    arrow = F.when(F.col("direction") == "out", F.concat(F.lit(" -"), "relation", F.lit("-> "))).otherwise(F.concat(F.lit(" <-"), "relation", F.lit("- ")))
    facts = facts.withColumn("fact", F.concat("entity", arrow, "neighbor"))
    semantic = gr.within_budget(facts, "query_id", [F.col("score").desc(), "entity", "relation", "neighbor", "direction"], "fact", SEMANTIC_CHARS)
    return gr.context_assembly(asked, episodic, semantic, "query_id")
