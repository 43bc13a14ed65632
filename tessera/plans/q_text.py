"""Text, de-duplication and predicate queries (fixtures F2, F5, F8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import FULL_WIDTH, HALF_WIDTH, WS_CLASS, char_tokens, collapse_ws, normalize_width
from tessera.operators import dedup, filters, text
from tessera.plans.registry import register
from tessera.plans.sqlkit import collapse, strip
from tessera.sources.tables import table

LANGS = ["en", "fr", "de", "es"]

# ---------------------------------------------------------------- fixture F8: markdown built from documents


def _prefix(i):
    return (F.when(i % 20 == 19, F.lit("#### "))
            .when(i % 5 == 4, F.when(F.floor(i / 5) % 2 == 0, F.lit("## ")).otherwise(F.lit("### ")))
            .otherwise(F.lit("")))


def markdown_docs(spark, sf) -> DataFrame:
    """Every fifth line becomes a level-2/3 heading (every twentieth a level-4 one)."""
    d = table(spark, sf, "documents").select("doc_id", "lang", "text")
    lines = F.split(F.col("text"), "\n")
    md = F.array_join(F.transform(lines, lambda l, i: F.concat(_prefix(i), l)), "\n")
    return d.select("doc_id", "lang", md.alias("text"))


def paragraph_docs(spark, sf) -> DataFrame:
    """Lines of a document joined by a blank line (no heading)."""
    d = table(spark, sf, "documents").select("doc_id", "lang", "text")
    return d.select("doc_id", "lang", F.array_join(F.split(F.col("text"), "\n"), "\n\n").alias("text"))


PREFIX_SQL = ("(CASE WHEN i % 20 = 19 THEN '#### ' WHEN i % 5 = 4 THEN "
              "(CASE WHEN (i // 5) % 2 = 0 THEN '## ' ELSE '### ' END) ELSE '' END)")
LINES_SQL = """
lines AS (
  SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
  FROM documents)
"""
SECTIONS_SQL = "WITH " + LINES_SQL + f""",
m AS (SELECT doc_id, lang, i, {PREFIX_SQL} || line AS md,
             regexp_matches({PREFIX_SQL} || line, '^#{{2,3}}{WS_CLASS}+.') AS is_h FROM lines),
s AS (SELECT *, sum(CASE WHEN is_h THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS seg FROM m),
b AS (SELECT doc_id, lang, CAST(seg AS INTEGER) AS block, {strip("string_agg(md, chr(10) ORDER BY i)")} AS section
      FROM s WHERE seg > 0 GROUP BY doc_id, lang, seg)
"""
PARAS_SQL = "WITH " + LINES_SQL + f""",
p AS (SELECT doc_id, lang, {strip('line')} AS section FROM lines)
"""


@register("t1_md_sections", SECTIONS_SQL + " SELECT doc_id, block, section FROM b WHERE length(section) >= 100")
def t1(spark, sf):
    return text.md_sections(markdown_docs(spark, sf).drop("lang"))


@register("t2_md_paragraphs", PARAS_SQL + " SELECT doc_id, section FROM p WHERE length(section) >= 100")
def t2(spark, sf):
    return text.md_paragraphs(paragraph_docs(spark, sf).drop("lang")).select("doc_id", "section")


@register("t1_t2_sections_or_paragraphs", f"""
WITH md AS ({SECTIONS_SQL} SELECT doc_id, section FROM b WHERE lang = 'en' AND length(section) >= 100),
pa AS ({PARAS_SQL} SELECT doc_id, section FROM p WHERE lang <> 'en' AND length(section) >= 100),
nh AS (SELECT doc_id, {strip('text')} AS section FROM documents
       WHERE lang = 'en' AND len(string_split(text, chr(10))) < 5 AND length({strip('text')}) >= 100)
SELECT * FROM md UNION ALL SELECT * FROM pa UNION ALL SELECT * FROM nh
""")
def t1t2(spark, sf):
    mixed = (markdown_docs(spark, sf).where(F.col("lang") == "en")
             .unionByName(paragraph_docs(spark, sf).where(F.col("lang") != "en")))
    return text.sections_or_paragraphs(mixed.drop("lang")).select("doc_id", "section")


# ---------------------------------------------------------------- T3-T5, D1, D4, J9, P4 on documents

# Literal rows for T3 (the documents hold no full-width characters); the query reads the table too.
WIDTH_LITERALS = ["ＡＢＣ１２３！", "’", "。", "＇", "ｈｅｌｌｏ，ｗｏｒｌｄ？"]


@register("t3_normalize_width", f"""
SELECT doc_id, translate(text, '{FULL_WIDTH}', '{HALF_WIDTH.replace("'", "''")}') AS text_norm
FROM (SELECT doc_id, text FROM documents
      UNION ALL SELECT * FROM (VALUES {", ".join(f"({-i - 1}, '{s}')" for i, s in enumerate(WIDTH_LITERALS))}) v(doc_id, text))
""")
def t3(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    lit = spark.createDataFrame([(-i - 1, s) for i, s in enumerate(WIDTH_LITERALS)], "doc_id bigint, text string")
    return d.unionByName(lit).select("doc_id", normalize_width(F.col("text")).alias("text_norm"))


@register("t4_char_tokens", f"""
WITH t AS (SELECT doc_id, string_split(translate(text, '{FULL_WIDTH}', '{HALF_WIDTH.replace("'", "''")}'), '') AS toks FROM documents)
SELECT doc_id, CAST(len(toks) AS INTEGER) AS n_tokens, md5(array_to_string(toks, '|')) AS tokens_md5 FROM t
""")
def t4(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", char_tokens(F.col("text")).alias("toks"))
    return d.select("doc_id", F.size("toks").alias("n_tokens"), F.md5(F.array_join("toks", "|")).alias("tokens_md5"))


@register("t5_collapse_ws", f"SELECT doc_id, {collapse('text')} AS text_ws FROM documents")
def t5(spark, sf):
    return table(spark, sf, "documents").select("doc_id", collapse_ws(F.col("text")).alias("text_ws"))


@register("d1_dedup_prefix", f"""
WITH k AS (SELECT doc_id, md5(lower({collapse('text')})) AS dedup_key FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY doc_id) AS rn FROM k)
SELECT dedup_key, doc_id FROM r WHERE rn = 1
""")
def d1(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    return dedup.dedup_prefix(d, "text", ["doc_id"], payload=[]).select("dedup_key", "doc_id")


@register("d4_union_sources", """
SELECT DISTINCT doc_id, lang, source FROM (
  SELECT doc_id, lang, source FROM documents WHERE lang IN ('en', 'fr')
  UNION ALL SELECT doc_id, lang, source FROM documents WHERE source IN ('src0', 'src1', 'src2', 'src3', 'src4'))
""")
def d4(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "source")
    a = d.where(F.col("lang").isin("en", "fr"))
    b = d.where(F.col("source").isin("src0", "src1", "src2", "src3", "src4"))
    return dedup.union_sources([a, b], ["doc_id"])


@register("j9_anti_seen", """
SELECT doc_id, n_chars FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""")
def j9(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    return dedup.anti_seen(d, table(spark, sf, "labels"), ["doc_id"])


@register("p4_select_classes", "SELECT doc_id, lang FROM documents WHERE lang IN ('en', 'de')")
def p4(spark, sf):
    return filters.select_classes(table(spark, sf, "documents").select("doc_id", "lang"), "lang", ["en", "de"])


# ---------------------------------------------------------------- pages (F8)

@register("p3_filter_extension", """
SELECT page_id, url FROM pages WHERE suffix(lower(url), '.html') OR suffix(lower(url), '/')
""")
def p3(spark, sf):
    return filters.filter_extension(table(spark, sf, "pages").select("page_id", "url"), "url", [".HTML", "/"])


@register("p5_quarantine_invalid", """
SELECT page_id,
  CASE WHEN strpos(html, '<h1') = 0 THEN 'no_h1' WHEN strpos(html, '<h2') > 0 THEN 'has_h2'
       WHEN NOT starts_with(url, 'https://') THEN 'not_https' END AS reason,
  (strpos(html, '<h1') > 0 AND strpos(html, '<h2') = 0 AND starts_with(url, 'https://')) AS is_valid
FROM pages
""")
def p5(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url", "html")
    rules = [("no_h1", F.instr("html", "<h1") > 0), ("has_h2", F.instr("html", "<h2") == 0),
             ("not_https", F.col("url").startswith("https://"))]
    return filters.quarantine_invalid(p, rules).select("page_id", "reason", "is_valid")


@register("p7_label_from_path", """
SELECT page_id, list_filter(string_split(replace(url, '\\', '/'), '/'), lambda x: list_contains(['en', 'fr', 'de', 'es'], x))[1] AS label
FROM pages
""")
def p7(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url")
    return p.select("page_id", filters.label_from_path(F.col("url"), LANGS).alias("label"))


# ---------------------------------------------------------------- events

K_SQL = "regexp_extract(props, '([0-9]+)', 1)"


def _k():
    return F.regexp_extract(F.col("props"), "([0-9]+)", 1)


def _json_raw():
    et, k = F.col("event_type"), _k()
    return (F.when(et == "view", F.concat(et, F.lit(" event, no payload")))
            .when(et == "error", F.concat(F.lit('Error: {"instruction": "'), et, F.lit('", "output": }')))
            .when(et == "signup", F.concat(F.lit('Result: {"instruction": "'), et, F.lit(" "), k,
                                           F.lit('", "output": "   "} done')))
            .otherwise(F.concat(F.lit('Result: {"instruction": " '), et, F.lit(" "), k,
                                F.lit(' ", "output": "user '), F.col("user_id").cast("string"), F.lit('"} done'))))


JSON_RAW_SQL = f"""(CASE WHEN event_type = 'view' THEN event_type || ' event, no payload'
  WHEN event_type = 'error' THEN 'Error: {{"instruction": "' || event_type || '", "output": }}'
  WHEN event_type = 'signup' THEN 'Result: {{"instruction": "' || event_type || ' ' || {K_SQL} || '", "output": "   "}} done'
  ELSE 'Result: {{"instruction": " ' || event_type || ' ' || {K_SQL} || ' ", "output": "user ' || CAST(user_id AS VARCHAR) || '"}} done' END)"""


@register("t6_extract_json_pair", f"""
WITH r AS (SELECT event_id, regexp_extract({JSON_RAW_SQL}, '(?s)(\\{{.*\\}})', 1) AS raw FROM events),
p AS (SELECT event_id, raw, json_valid(raw) AND length(raw) > 0 AS ok,
             CASE WHEN json_valid(raw) AND length(raw) > 0 THEN {strip("json_extract_string(raw, '$.instruction')")} END AS instruction,
             CASE WHEN json_valid(raw) AND length(raw) > 0 THEN {strip("json_extract_string(raw, '$.output')")} END AS output
      FROM r)
SELECT event_id, instruction, output,
  CASE WHEN length(raw) = 0 THEN 'no_json' WHEN NOT ok THEN 'bad_json'
       WHEN instruction IS NULL OR length(instruction) = 0 OR output IS NULL OR length(output) = 0 THEN 'empty_field' END AS reason
FROM p
""")
def t6(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type", "user_id", "props")
    raw = e.select("event_id", _json_raw().alias("raw"))
    return text.extract_json_pair(raw, "raw").select("event_id", "instruction", "output", "reason")


@register("t7_validate_struct", """
WITH p AS (SELECT event_id, TRY_CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)
SELECT event_id, k, CASE WHEN k IS NULL THEN 'k:missing' WHEN k < 1 OR k > 10 THEN 'k:range' END AS reason,
       (k IS NOT NULL AND k BETWEEN 1 AND 10) AS is_valid
FROM p
""")
def t7(spark, sf):
    e = table(spark, sf, "events").select("event_id", "props")
    return text.validate_struct(e, "props", "k int", {"k": (1, 10)}).select("event_id", "k", "reason", "is_valid")


def plan_steps(spark, sf) -> DataFrame:
    """Plan step strings: ``web_search('<type> <k>')``; one row in five without quotes."""
    e = table(spark, sf, "events").select("event_id", "event_type", "props")
    q = F.concat(F.col("event_type"), F.lit(" "), _k())
    step = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("web_search("), q, F.lit(")"))) \
        .otherwise(F.concat(F.lit("web_search('"), q, F.lit("')")))
    return e.select("event_id", step.alias("step"))


STEP_SQL = f"""(CASE WHEN event_id % 5 = 0 THEN 'web_search(' || event_type || ' ' || {K_SQL} || ')'
  ELSE 'web_search(''' || event_type || ' ' || {K_SQL} || ''')' END)"""
TOOL_RE = text.TOOL_CALL.removeprefix("(?U)").replace('\\"', '"').replace("'", "''")  # RE2 has no such flag


@register("t8_parse_tool_call", f"""
WITH s AS (SELECT event_id, {STEP_SQL} AS step FROM events)
SELECT event_id,
  CASE WHEN regexp_matches(step, '{TOOL_RE}') THEN regexp_extract(step, '{TOOL_RE}', 1) ELSE 'web_search' END AS tool,
  CASE WHEN regexp_matches(step, '{TOOL_RE}') THEN regexp_extract(step, '{TOOL_RE}', 2) ELSE step END AS query
FROM s
""")
def t8(spark, sf):
    return text.parse_tool_call(plan_steps(spark, sf), "step").select("event_id", "tool", "query")


@register("p6_coalesce_placeholder", f"""
SELECT event_id, event_type,
       coalesce(CASE WHEN event_type <> 'error' THEN TRY_CAST({K_SQL} AS INTEGER) END, -1) AS k
FROM events
""")
def p6(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type", "props")
    decoded = F.when(F.col("event_type") != "error", _k().try_cast("int"))
    return e.select("event_id", "event_type", filters.coalesce_placeholder(decoded, -1).alias("k"))


@register("p8_case_route", f"""
SELECT event_id,
  CASE WHEN event_type = 'error' THEN 'retry'
       WHEN event_type = 'click' AND TRY_CAST({K_SQL} AS INTEGER) > 50 THEN 'tool'
       WHEN event_type = 'purchase' THEN 'billing' ELSE 'end' END AS route
FROM events
""")
def p8(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type", "props")
    et = F.col("event_type")
    route = filters.case_route([(et == "error", "retry"),
                                ((et == "click") & (_k().try_cast("int") > 50), "tool"),
                                (et == "purchase", "billing")], "end")
    return e.select("event_id", route.alias("route"))


@register("t12_keyword_split", f"""
WITH w AS (SELECT p_partkey, list_filter(regexp_split_to_array(p_name, '{WS_CLASS}+'), lambda x: x <> '') AS ws FROM part)
SELECT p_partkey, CAST(generate_subscripts(ws, 1) - 1 AS INTEGER) AS pos, unnest(ws) AS keyword FROM w
""")
def t12(spark, sf):
    return text.keyword_split(table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", "p_partkey")
