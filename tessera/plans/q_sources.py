"""Source/sink queries: each writes a table derived from the fixtures into a fresh folder
under the shared checkpoint folder and reads it back through the scan under test."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.numeric import r6
from pyspark.sql import types as T

from tessera.operators import chat
from tessera.operators.dedup import anti_seen, last_per_key
from tessera.plans.q_chat import conversations
from tessera.plans.q_eval import HIST_SQL, PRED_SQL, _per_class, counted, history
from tessera.plans.q_tokens import tr, vocabulary
from tessera.plans.registry import register
from tessera.plans.sqlkit import PC_CTE
from tessera.sources import files
from tessera.sources.tables import table

CONV_SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                            T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
PC_SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                          T.StructField("prompt", T.StringType()), T.StructField("completion", T.StringType())])


@register("s1_scan_text", """
SELECT source, CAST(sum(length(text) + 1) AS BIGINT) AS n_chars FROM documents GROUP BY source
""")
def s1(spark, sf):
    out = files.scratch_dir(spark, "s1")
    d = table(spark, sf, "documents").select("source", "text")
    # small files, as a folder of texts holds; every text ends with a line end
    d.write.mode("overwrite").partitionBy("source").option("maxRecordsPerFile", 64).text(out)
    t = files.scan_text(spark, out)
    return (t.groupBy(F.regexp_extract("path", "source=([^/]+)/", 1).alias("source"))
            .agg(F.sum(F.length("text")).cast("long").alias("n_chars")))


@register("s2_scan_jsonl", "SELECT conv_id, turn, role, text FROM conversations")
def s2(spark, sf):
    out = files.scratch_dir(spark, "s2")
    files.sink_jsonl(conversations(spark, sf), out)
    r = files.scan_jsonl(spark, out, CONV_SCHEMA)
    return r.where(F.col("_corrupt_record").isNull()).select("conv_id", "turn", "role", "text")


@register("s3_sink_jsonl", "WITH " + PC_CTE + " SELECT conv_id, turn, prompt, completion FROM pc")
def s3(spark, sf):
    out = files.scratch_dir(spark, "s3")
    files.sink_jsonl(chat.to_prompt_completion(conversations(spark, sf)), out)
    return files.scan_jsonl(spark, out, PC_SCHEMA).drop("_corrupt_record")


@register("s4_latest_version", """
SELECT o_custkey, o_orderkey, o_orderstatus FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1
""")
def s4(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    return last_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderstatus"]).select(
        "o_custkey", "o_orderkey", "o_orderstatus")


@register("s5_scan_labelled_tree", r"""
WITH p AS (SELECT regexp_extract(url, '^[a-z]+://[^/]+/([a-z][a-z])/', 1) AS lang, html FROM pages)
SELECT CASE WHEN lang = '' THEN 'unlabelled' ELSE lang END AS label, CAST(sum(strlen(html) + 1) AS BIGINT) AS bytes FROM p GROUP BY 1
""")
def s5(spark, sf):
    root = files.scratch_dir(spark, "s5")
    lang = F.regexp_extract("url", "^[a-z]+://[^/]+/([a-z][a-z])/", 1)  # classes as the data has them
    p = table(spark, sf, "pages").select("html", F.when(lang == "", "unlabelled").otherwise(lang).alias("label"))
    p.write.mode("overwrite").partitionBy("label").text(root)  # root/label=<class>/part-*.txt
    listing = files.scan_labelled_tree(spark, root, [".TXT"])
    return (listing.groupBy(F.regexp_replace("label", "^label=", "").alias("label"))
            .agg(F.sum("length").cast("long").alias("bytes")))


@register("s7_scan_json_array", "WITH " + PC_CTE + f""",
toks AS (SELECT unnest(string_split({tr('text')}, '')) AS tok FROM conversations),
vc AS (SELECT tok, count(*) AS n FROM toks GROUP BY tok),
vocab AS (SELECT tok AS token, CAST(row_number() OVER (ORDER BY n DESC, tok) + 1 AS INTEGER) AS id FROM vc)
SELECT token, id FROM vocab UNION ALL SELECT '<PAD>', 0 UNION ALL SELECT '<UNK>', 1
""")
def s7(spark, sf):
    from tessera.operators.tokens import with_specials
    out = files.scratch_dir(spark, "s7")
    files.write_json_array(with_specials(vocabulary(spark, sf)), "token", "id", out)
    return files.scan_json_array(spark, out).select("token", "id")


@register("s8_sink_metrics", PRED_SQL + """
, m AS (SELECT a.cls AS t, string_agg(CAST((SELECT count(*) FROM pc WHERE pc.label = a.cls AND pc.pred = b.cls) AS VARCHAR), ' ' ORDER BY b.cls) AS line
      FROM cls a, cls b GROUP BY a.cls),
""" + HIST_SQL.replace("WITH b", "b", 1) + """
SELECT (SELECT string_agg(CAST(cls AS VARCHAR), ',' ORDER BY cls) FROM cls) AS class_names,
       round(avg(CASE WHEN correct THEN 1.0 ELSE 0.0 END) * 100, 6) AS accuracy, count(*) AS n_rows,
       (SELECT string_agg(line, ';' ORDER BY t) FROM m) AS confusion_matrix,
       (SELECT count(*) FROM h WHERE run = 'view') AS n_epochs,
       (SELECT round(sum(loss), 6) FROM h WHERE run = 'view') AS loss_sum, (SELECT round(sum(f1), 6) FROM prf1) AS f1_sum, true AS has_time FROM pc
""")
def s8(spark, sf):
    out = files.scratch_dir(spark, "s8")
    counts = counted(spark, sf)
    run = history(spark, sf).where("run = 'view'")
    files.sink_metrics(files.metrics_document(counts, "label", "pred", "n", _per_class(spark, sf, counts), run), out)
    back = spark.read.json(out)
    total = lambda c, f: F.aggregate(c, F.lit(0.0), lambda a, x: a + x[f])
    return back.select(F.array_join("class_names", ",").alias("class_names"), r6("metrics.accuracy", 6).alias("accuracy"),
                       F.col("metrics.n_rows").alias("n_rows"),
                       F.array_join(F.transform("confusion_matrix", lambda r: F.array_join(r.cast("array<string>"), " ")), ";").alias("confusion_matrix"),
                       F.size("history").cast("long").alias("n_epochs"), r6(total("history", "loss"), 6).alias("loss_sum"),
                       r6(total("per_class", "f1"), 6).alias("f1_sum"), F.to_timestamp("timestamp").isNotNull().alias("has_time"))


ORDERS_SCHEMA = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderstatus", T.StringType())])


@register("s4_latest_folder", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = (SELECT max(o_orderstatus) FROM orders)
""")
def s4_folder(spark, sf):
    """A dataset version per order status, written one after the other; the scan finds the one written last."""
    root = files.scratch_dir(spark, "s4")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    for r in o.select("o_orderstatus").distinct().orderBy("o_orderstatus").collect():  # a handful of states
        o.where(F.col("o_orderstatus") == r["o_orderstatus"]).write.mode("overwrite").json(f"{root}/version_{r['o_orderstatus']}")
    return files.latest_version_folder(spark, root, ORDERS_SCHEMA)


CLASS_LIST = ["de", "en", "es", "zz"]  # zz has no folder


@register("s5_wanted_classes", r"""
WITH p AS (SELECT regexp_extract(url, '^[a-z]+://[^/]+/([a-z][a-z])/', 1) AS lang, html FROM pages)
SELECT c.label, CAST(coalesce(sum(strlen(html) + 1), 0) AS BIGINT) AS bytes, count(html) = 0 AS missing
FROM (VALUES ('de'), ('en'), ('es'), ('zz')) c(label) LEFT JOIN p ON p.lang = c.label GROUP BY c.label
""")
def s5_wanted(spark, sf):
    root = files.scratch_dir(spark, "s5w")
    lang = F.regexp_extract("url", "^[a-z]+://[^/]+/([a-z][a-z])/", 1)
    table(spark, sf, "pages").select("html", F.when(lang == "", "unlabelled").otherwise(lang).alias("label")).write.mode("overwrite").partitionBy("label").text(root)
    report = files.labelled_tree_report(spark, root, [f"label={c}" for c in CLASS_LIST], [".TXT"])
    return report.select(F.regexp_replace("label", "^label=", "").alias("label"), "bytes", "missing")


@register("s10_sink_overwrite", """
SELECT doc_id, n_chars FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""")
def s10(spark, sf):
    out = files.scratch_dir(spark, "s10")
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    new = anti_seen(d, table(spark, sf, "labels"), ["doc_id"])
    files.sink_overwrite(d, out)      # an earlier run's output ...
    files.sink_overwrite(new, out)    # ... is replaced, not appended to
    return spark.read.parquet(out)
