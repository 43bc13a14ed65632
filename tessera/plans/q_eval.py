"""Evaluation, split and training-history queries (fixtures F2, F4, F5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.numeric import r6

from tessera.operators import evaluate as ev
from tessera.operators.sampling import sample_n
from tessera.plans.registry import register
from tessera.sources.tables import table

CLASSES = list(range(10))
SEED = "42"

# ------------------------------------------------------------------ F4: predictions from embeddings


def predictions(spark, sf) -> DataFrame:
    e = table(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    # ten logits from the whole vector: component i counts for class i mod 10; one fold over its rows of ten
    rows = F.sequence(F.lit(0), F.greatest(F.ceil(F.size("embedding") / 10).cast("int") - 1, F.lit(0)))
    logits = F.aggregate(rows, F.array_repeat(F.lit(0.0), 10), lambda acc, j: F.zip_with(
        acc, F.slice("embedding", j * 10 + 1, 10), lambda a, x: a + F.coalesce(x.cast("double") * 10, F.lit(0.0))))
    p = e.select("vec_id", "label", ev.softmax(logits).alias("probs"))
    return (p.withColumn("pred", ev.argmax(F.col("probs")))
            .withColumn("conf", ev.confidence(F.col("probs")))
            .withColumn("correct", F.col("pred") == F.col("label")))


def counted(spark, sf) -> DataFrame:
    return ev.contingency(predictions(spark, sf), "label", "pred")


def class_rows(p: DataFrame) -> DataFrame:
    """The class ids, taken from the data's label domain plus predictions."""
    return (p.select(F.col("label").alias("cls")).unionByName(p.select(F.col("pred").alias("cls")))
            .distinct())


PRED_SQL = """
WITH lg AS (SELECT vec_id, label, list_transform(range(10), lambda k: list_reduce(
               list_transform(embedding, lambda x, i: CASE WHEN (i - 1) % 10 = k THEN CAST(x AS DOUBLE) * 10 ELSE 0.0 END), lambda a, b: a + b)) AS logits FROM embeddings),
ex AS (SELECT vec_id, label, list_transform(logits, lambda x: exp(x - list_max(logits))) AS ex FROM lg),
pp AS (SELECT vec_id, label, list_transform(ex, lambda x: x / list_reduce(ex, lambda a, b: a + b)) AS probs FROM ex),
pd AS (SELECT vec_id, label, probs, CAST(list_position(probs, list_max(probs)) - 1 AS INTEGER) AS pred,
              list_max(probs) AS conf FROM pp),
pc AS (SELECT *, pred = label AS correct FROM pd),
cls AS (SELECT DISTINCT cls FROM (SELECT label AS cls FROM pc UNION ALL SELECT pred FROM pc)),
cnt AS (
  SELECT c.cls, coalesce(t.support, 0) AS support, coalesce(t.tp, 0) AS tp, coalesce(p.predicted, 0) AS predicted
  FROM cls c
  LEFT JOIN (SELECT label AS cls, count(*) AS support, sum(CASE WHEN correct THEN 1 ELSE 0 END) AS tp FROM pc GROUP BY 1) t USING (cls)
  LEFT JOIN (SELECT pred AS cls, count(*) AS predicted FROM pc GROUP BY 1) p USING (cls)),
prf AS (
  SELECT cls, support,
         coalesce(CAST(tp AS DOUBLE) / nullif(predicted, 0), 0.0) AS precision,
         coalesce(CAST(tp AS DOUBLE) / nullif(support, 0), 0.0) AS recall
  FROM cnt),
prf1 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM prf)
"""


@register("a9_softmax", PRED_SQL + " SELECT vec_id, " + ", ".join(
    f"round(probs[{i + 1}], 6) AS p{i}" for i in range(10)) + " FROM pc")
def a9(spark, sf):
    p = predictions(spark, sf)
    return p.select("vec_id", *[r6(F.element_at("probs", i + 1), 6).alias(f"p{i}") for i in range(10)])


@register("a10_argmax_confidence", PRED_SQL + " SELECT vec_id, pred, round(conf, 6) AS conf FROM pc")
def a10(spark, sf):
    return predictions(spark, sf).select("vec_id", "pred", r6("conf", 6).alias("conf"))


@register("w8_topk_classes", PRED_SQL + """,
z AS (SELECT vec_id, list_sort(list_transform(probs, lambda p, i: {'prob': p, 'neg_idx': -(i - 1)}), 'DESC')[1:3] AS top FROM pc)
SELECT vec_id, 'class_' || CAST(-top[1].neg_idx AS VARCHAR) AS top1, round(top[1].prob, 6) AS top1_prob,
       'class_' || CAST(-top[2].neg_idx AS VARCHAR) AS top2, round(top[2].prob, 6) AS top2_prob,
       'class_' || CAST(-top[3].neg_idx AS VARCHAR) AS top3, round(top[3].prob, 6) AS top3_prob FROM z
""")
def w8(spark, sf):
    names = F.array(*[F.lit(f"class_{c}") for c in CLASSES])
    p = predictions(spark, sf).select("vec_id", ev.topk_classes(F.col("probs"), names, 3).alias("top"))
    cols = []
    for i in range(3):
        cols += [F.col("top")[i]["cls"].alias(f"top{i + 1}"), r6(F.col("top")[i]["prob"], 6).alias(f"top{i + 1}_prob")]
    return p.select("vec_id", *cols)


@register("a11_smoothed_ce", PRED_SQL + """
SELECT vec_id, round(0.9 * -ln(probs[label + 1]) + 0.1 / len(probs) * list_reduce(list_transform(probs, lambda p: -ln(p)), lambda a, b: a + b), 6) AS loss FROM pc
""")
def a11(spark, sf):
    p = predictions(spark, sf)
    return p.select("vec_id", r6(ev.smoothed_ce(F.col("probs"), F.col("label"), 0.1), 6).alias("loss"))


@register("g2_accuracy", PRED_SQL + " SELECT round(avg(CASE WHEN correct THEN 1.0 ELSE 0.0 END) * 100, 6) AS accuracy FROM pc")
def g2(spark, sf):
    return ev.accuracy(predictions(spark, sf), "label", "pred").select(r6("accuracy", 6).alias("accuracy"))


def _per_class(spark, sf, p: DataFrame | None = None):
    p = counted(spark, sf) if p is None else p
    return ev.prf(ev.class_counts(p, "label", "pred", "n"))


@register("g3_weighted_prf", PRED_SQL + """
SELECT round(sum(precision * support) / sum(support) * 100, 6) AS precision,
       round(sum(recall * support) / sum(support) * 100, 6) AS recall,
       round(sum(f1 * support) / sum(support) * 100, 6) AS f1 FROM prf1
""")
def g3(spark, sf):
    w = ev.weighted_prf(_per_class(spark, sf))
    return w.select(*[r6(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@register("g4_classification_report", PRED_SQL + """
SELECT CAST(cls AS VARCHAR) AS label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM prf1
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM prf1
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
                 round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM prf1
UNION ALL SELECT 'accuracy', NULL, NULL, round(avg(CASE WHEN correct THEN 1.0 ELSE 0.0 END), 6), count(*) FROM pc
""")
def g4(spark, sf):
    r = ev.classification_report(ev.class_counts(counted(spark, sf), "label", "pred", "n"))
    return r.select("label", *[r6(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@register("g5_confusion_matrix", PRED_SQL + """
SELECT c.cls AS "true", """ + ", ".join(
    f"CAST(coalesce(sum(CASE WHEN pc.pred = {k} THEN 1 ELSE 0 END), 0) AS BIGINT) AS p{k}" for k in CLASSES) + """
FROM cls c LEFT JOIN pc ON pc.label = c.cls GROUP BY c.cls
""")
def g5(spark, sf):
    p = counted(spark, sf)
    return ev.confusion_matrix(p, "label", "pred", CLASSES, class_rows(p), "n")


# Short words that tell the four languages of the fixture apart, tried in this order.
MARK_WORDS = [("en", " the "), ("de", " der "), ("fr", " les "), ("es", " los ")]


def language_guesses(spark, sf) -> DataFrame:
    """(lang, guess): the language whose mark word stands most often in the text, null if none does."""
    d = table(spark, sf, "documents").select("lang", F.lower("text").alias("t"))
    hits = F.array(*[F.struct(((F.length("t") - F.length(F.replace("t", F.lit(w), F.lit("")))) / len(w)).alias("k"), F.lit(-i).alias("o"), F.lit(lang).alias("l"))
                     for i, (lang, w) in enumerate(MARK_WORDS)])
    best = F.array_max(hits)
    return d.select("lang", F.when(best["k"] > 0, best["l"]).alias("guess"))


@register("g5_confusion_by_class", """
WITH k AS (SELECT lang, """ + ", ".join(f"(length(lower(text)) - length(replace(lower(text), '{w}', ''))) / {len(w)} AS {lang}" for lang, w in MARK_WORDS) + """ FROM documents),
g AS (SELECT lang, CASE WHEN greatest(en, de, fr, es) = 0 THEN NULL WHEN en = greatest(en, de, fr, es) THEN 'en' WHEN de = greatest(en, de, fr, es) THEN 'de'
                        WHEN fr = greatest(en, de, fr, es) THEN 'fr' ELSE 'es' END AS guess FROM k),
c AS (SELECT DISTINCT c FROM (SELECT lang AS c FROM g UNION ALL SELECT guess FROM g) WHERE c IS NOT NULL)
SELECT a.c AS "true", b.c AS pred, CAST((SELECT count(*) FROM g WHERE g.lang = a.c AND g.guess = b.c) AS BIGINT) AS n FROM c a, c b
""")
def g5_by_class(spark, sf):
    counted_ = ev.contingency(language_guesses(spark, sf), "lang", "guess")
    return ev.confusion_counts(counted_, "lang", "guess", "n")


@register("g6_confidence_histogram", PRED_SQL + """,
s AS (SELECT 'all' AS series, conf AS x FROM pc UNION ALL SELECT CASE WHEN correct THEN 'correct' ELSE 'wrong' END, conf FROM pc),
e AS (SELECT series, min(x) AS lo, max(x) AS hi FROM s GROUP BY series)
SELECT series, CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((x - lo) / (hi - lo) * 20), 19) END AS INTEGER) AS bin, count(*) AS n
FROM s JOIN e USING (series) GROUP BY ALL
""")
def g6(spark, sf):
    return ev.confidence_histogram(predictions(spark, sf), "conf", "correct", 20)


@register("g7_confidence_stats", PRED_SQL + """
SELECT round(avg(conf), 6) AS mean_conf, round(avg(CASE WHEN correct THEN conf END), 6) AS mean_conf_correct,
       round(avg(CASE WHEN NOT correct THEN conf END), 6) AS mean_conf_wrong FROM pc
""")
def g7(spark, sf):
    s = ev.confidence_stats(predictions(spark, sf), "conf", "correct")
    return s.select(*[r6(c, 6).alias(c) for c in s.columns])


# ------------------------------------------------------------------ F2: documents, labels, splits

def _shuf_sql(id_col: str) -> str:
    return f"md5(CAST({id_col} AS VARCHAR) || '{SEED}')"


SPLIT_SQL = f"""
WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {_shuf_sql('doc_id')}, doc_id) AS rn,
                  count(*) OVER (PARTITION BY lang) AS n FROM documents),
sp AS (SELECT doc_id, lang, CASE WHEN rn <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS split FROM r)
"""


def split_docs(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "lang")
    return ev.stratified_split(d, "doc_id", "lang", 0.8, SEED)


@register("w1_stratified_split", SPLIT_SQL + " SELECT doc_id, lang, split FROM sp")
def w1(spark, sf):
    return split_docs(spark, sf)


@register("g1_class_distribution", SPLIT_SQL + """
SELECT split, lang, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY split), 1) AS pct
FROM sp GROUP BY split, lang
""")
def g1(spark, sf):
    return ev.class_distribution(split_docs(spark, sf), "lang", "split")


@register("w2_sequence_ids", """
SELECT doc_id, source, printf('%s_%04d.txt', source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) AS new_name
FROM documents
""")
def w2(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source")
    return ev.sequence_ids(d, "source", "doc_id")


@register("w3_sample_n", f"SELECT doc_id, lang FROM documents ORDER BY {_shuf_sql('doc_id')}, doc_id LIMIT 128")
def w3(spark, sf):
    return sample_n(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 128, SEED)


@register("w3_sample_third", f"""
SELECT doc_id, lang FROM documents QUALIFY row_number() OVER (ORDER BY {_shuf_sql('doc_id')}, doc_id) <= (SELECT count(*) // 3 FROM documents)
""")
def w3_third(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    return sample_n(d, "doc_id", d.count() // 3, SEED)


@register("w9_sorted_counts", "SELECT lang, count(*) AS n FROM documents GROUP BY lang ORDER BY lang")
def w9(spark, sf):
    return ev.sorted_counts(table(spark, sf, "documents"), "lang")


@register("s9_dataset_manifest", """
WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang)
SELECT CAST(sum(n) AS BIGINT) AS total_rows, string_agg(lang, ',' ORDER BY lang) AS classes,
       string_agg(lang || ':' || CAST(n AS VARCHAR), ',' ORDER BY lang) AS per_class, 'documents by lang' AS source_note FROM c
""")
def s9(spark, sf):
    m = ev.dataset_manifest(table(spark, sf, "documents"), "lang", "documents by lang")
    return m.withColumn("total_rows", F.col("total_rows").cast("long"))


@register("g15_step_plan", """
WITH c AS (SELECT source, count(*) AS n_rows FROM documents GROUP BY source)
SELECT source, n_rows, CAST(16 AS BIGINT) AS effective_batch, CAST(ceil(n_rows / 16) AS BIGINT) AS steps_per_epoch,
       CAST(ceil(n_rows / 16) * 2 AS BIGINT) AS total_steps, CAST(ceil(ceil(n_rows / 16) * 2 * 0.05) AS BIGINT) AS warmup_steps FROM c
""")
def g15(spark, sf):
    return ev.step_plan(table(spark, sf, "documents"), "source", 4, 4, 2, 0.05)


def doc_predictions(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    return d.join(lab, "doc_id", "left").select(
        "doc_id", F.col("quality").alias("truth"), (F.col("n_chars") >= 500).cast("int").alias("pred"),
        (0.5 + 0.5 * F.least(F.abs(F.col("n_chars") - 500) / 500.0, F.lit(1.0))).alias("conf"))


@register("g8_eval_summary", """
WITH p AS (SELECT d.doc_id, l.quality AS truth, CAST(d.n_chars >= 500 AS INTEGER) AS pred,
                  0.5 + 0.5 * least(abs(d.n_chars - 500) / 500.0, 1.0) AS conf
           FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT round(avg(conf), 6) AS mean_conf, CAST(sum(CASE WHEN truth IS NOT NULL AND truth = pred THEN 1 ELSE 0 END) AS BIGINT) AS n_correct,
       CAST(sum(CASE WHEN truth IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_labelled,
       round(sum(CASE WHEN truth IS NOT NULL AND truth = pred THEN 1 ELSE 0 END) * 100.0
             / nullif(sum(CASE WHEN truth IS NOT NULL THEN 1 ELSE 0 END), 0), 6) AS accuracy FROM p
""")
def g8(spark, sf):
    s = ev.eval_summary(doc_predictions(spark, sf), "conf", "truth", "pred")
    return s.select(r6("mean_conf", 6).alias("mean_conf"), "n_correct", "n_labelled",
                    r6("accuracy", 6).alias("accuracy"))


# ------------------------------------------------------------------ F5: training history from events

def history_batches(spark, sf) -> DataFrame:
    e = table(spark, sf, "events").select("event_type", "ts", "value")
    return (e.groupBy(F.col("event_type").alias("run"), F.unix_date(F.to_date("ts")).alias("epoch"), F.hour("ts").alias("batch"))
            .agg((F.avg("value") / 100).alias("batch_loss"),
                 F.sum((F.col("value") > 50).cast("long")).alias("n_correct"), F.count(F.lit(1)).alias("n")))


def history(spark, sf) -> DataFrame:
    return ev.epoch_metrics(history_batches(spark, sf), "run", "epoch", "batch_loss", "n_correct", "n")


HIST_SQL = """
WITH b AS (SELECT event_type AS run, CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS epoch, CAST(hour(ts) AS INTEGER) AS batch,
                  avg(value) / 100 AS batch_loss, sum(CASE WHEN value > 50 THEN 1 ELSE 0 END) AS n_correct, count(*) AS n
           FROM events GROUP BY ALL),
h AS (SELECT run, epoch, avg(batch_loss) AS loss, sum(n_correct) / sum(n) AS accuracy FROM b GROUP BY run, epoch)
"""


@register("g9_epoch_metrics", HIST_SQL + " SELECT run, epoch, round(loss, 6) AS loss, round(accuracy, 6) AS accuracy FROM h")
def g9(spark, sf):
    h = history(spark, sf)
    return h.select("run", "epoch", r6("loss", 6).alias("loss"), r6("accuracy", 6).alias("accuracy"))


@register("w6_best_epoch", HIST_SQL + """
SELECT run, max(CASE WHEN rk = 1 THEN epoch END) AS best_epoch, round(max(accuracy), 6) AS best_value
FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY accuracy DESC, epoch) AS rk FROM h) GROUP BY run
""")
def w6(spark, sf):
    b = ev.best_epoch(history(spark, sf), "run", "epoch", "accuracy")
    return b.select("run", "best_epoch", r6("best_value", 6).alias("best_value"))


PATIENCE = 3


@register("w7_early_stopping", HIST_SQL + f""",
s AS (SELECT run, epoch, -loss AS score,
             max(-loss) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before
      FROM h),
i AS (SELECT *, (best_before IS NULL OR score >= best_before) AS improve FROM s),
g AS (SELECT *, sum(CASE WHEN improve THEN 1 ELSE 0 END) OVER (PARTITION BY run ORDER BY epoch) AS grp FROM i),
c AS (SELECT *, row_number() OVER (PARTITION BY run, grp ORDER BY epoch) - 1 AS counter FROM g),
st AS (SELECT run, min(CASE WHEN counter >= {PATIENCE} THEN epoch END) AS stop_epoch FROM c GROUP BY run)
SELECT run, stop_epoch, round(max(CASE WHEN epoch <= coalesce(stop_epoch, 999) THEN score END), 6) AS best_score
FROM c JOIN st USING (run) GROUP BY run, stop_epoch
""")
def w7(spark, sf):
    s = ev.early_stopping(history(spark, sf), "run", "epoch", "loss", PATIENCE, 0.0)
    return s.select("run", "stop_epoch", r6("best_score", 6).alias("best_score"))
