"""Token, mask, batch and loss queries (fixture F3: character tokens of the F1 dialogs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.numeric import r6

from tessera.functions.text import FULL_WIDTH, HALF_WIDTH, IM_START, char_tokens, normalize_width
from tessera.operators import chat, tokens
from tessera.plans.q_chat import conversations
from tessera.plans.registry import register
from tessera.plans.sqlkit import PC_CTE

MAX_LEN = 512
BATCH = 4
BUCKETS = 8
SEED = "42"
MARKER = IM_START + "assistant"
M = len(MARKER)


def sequences(spark, sf) -> DataFrame:
    pc = chat.to_prompt_completion(conversations(spark, sf))
    return pc.select((F.col("conv_id") * 1000 + F.col("turn")).alias("seq_id"),
                     char_tokens(F.concat("prompt", "completion")).alias("tokens"),
                     F.length(normalize_width(F.col("prompt"))).alias("prompt_len"))


def vocabulary(spark, sf) -> DataFrame:
    return tokens.build_vocab(conversations(spark, sf), "text", 2)


def encoded(spark, sf) -> DataFrame:
    """Sequences with their ids and the marker's ids (one row, as long as the marker)."""
    v = vocabulary(spark, sf)
    mark = spark.range(1).select(F.split(F.lit(MARKER), "").alias("_toks"), F.col("id").alias("_k"))
    mark = tokens.vocab_encode(mark, ["_k"], "_toks", v, "marker").select("marker")
    s = tokens.vocab_encode(sequences(spark, sf), ["seq_id"], "tokens", v, "ids")
    return tokens.attach_small(s.select("seq_id", "prompt_len", "ids"), mark)


def batched(spark, sf) -> DataFrame:
    e = encoded(spark, sf).withColumn("labels", tokens.labels_prompt_cut(F.col("ids"), F.col("prompt_len")))
    b = tokens.assign_batches(e, "seq_id", BATCH, SEED)
    return tokens.pad_batch(b, "batch", "ids", "labels")


def js(c):
    return F.array_join(F.col(c) if isinstance(c, str) else c, ",")


# ---- oracle fragments


def tr(x: str) -> str:
    return f"translate({x}, '{FULL_WIDTH}', '{HALF_WIDTH.replace(chr(39), chr(39) * 2)}')"


TOK_SQL = "WITH " + PC_CTE + f""",
toks AS (SELECT unnest(string_split({tr('text')}, '')) AS tok FROM conversations),
vc AS (SELECT tok, count(*) AS n FROM toks GROUP BY tok),
vocab AS (SELECT tok, CAST(row_number() OVER (ORDER BY n DESC, tok) + 1 AS INTEGER) AS id FROM vc),
seqs AS (SELECT conv_id * 1000 + turn AS seq_id, string_split({tr('prompt || completion')}, '') AS tl,
                CAST(length({tr('prompt')}) AS INTEGER) AS prompt_len FROM pc),
ex AS (SELECT seq_id, unnest(tl) AS tok, generate_subscripts(tl, 1) AS pos FROM seqs),
enc0 AS (SELECT seq_id, list(coalesce(v.id, 1) ORDER BY pos) AS ids FROM ex LEFT JOIN vocab v USING (tok) GROUP BY seq_id),
enc AS (SELECT s.seq_id, s.prompt_len, coalesce(e.ids, []::INTEGER[]) AS ids FROM seqs s LEFT JOIN enc0 e USING (seq_id)),
mk AS (SELECT list(coalesce(v.id, 1) ORDER BY pos) AS mk
       FROM (SELECT unnest(string_split('{MARKER}', '')) AS tok, generate_subscripts(string_split('{MARKER}', ''), 1) AS pos) x
       LEFT JOIN vocab v USING (tok)),
lab AS (SELECT *, list_concat(list_transform(range(least(prompt_len, len(ids))), lambda x: -100), ids[least(prompt_len, len(ids)) + 1:]) AS labels
        FROM enc),
bat AS (SELECT *, CAST(floor((row_number() OVER (ORDER BY md5(CAST(seq_id AS VARCHAR) || '{SEED}'), seq_id) - 1) / {BATCH}) AS BIGINT) AS batch FROM lab),
tt AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch) AS T FROM bat),
pad AS (SELECT seq_id, batch, list_concat(ids[1:T], list_transform(range(T - len(ids[1:T])), lambda x: 0)) AS ids,
               list_concat(labels[1:T], list_transform(range(T - len(labels[1:T])), lambda x: -100)) AS labels FROM tt)
"""


def mask_sql(ids: str) -> str:
    return (f"list_transform({ids}, lambda x, p: CASE WHEN j IS NOT NULL AND p - 1 >= j - 1 + {M} + 1 THEN 1 ELSE 0 END)")


MARKPOS_SQL = f"CAST(list_filter(range(1, len(ids) - {M} + 2), lambda i: ids[i] = mk[1] AND ids[i:i + {M - 1}] = mk)[1] AS INTEGER)"


@register("j2_vocab_encode", TOK_SQL + " SELECT seq_id, array_to_string(ids, ',') AS ids FROM enc")
def j2(spark, sf):
    v = vocabulary(spark, sf)
    e = tokens.vocab_encode(sequences(spark, sf), ["seq_id"], "tokens", v, "ids")
    return e.select("seq_id", js("ids").alias("ids"))


@register("a1_truncate_tokens", TOK_SQL + f" SELECT seq_id, array_to_string(ids[1:{MAX_LEN}], ',') AS ids FROM enc")
def a1(spark, sf):
    return encoded(spark, sf).select("seq_id", js(tokens.truncate_tokens(F.col("ids"), MAX_LEN)).alias("ids"))


@register("a2_loss_mask_marker", TOK_SQL + f""",
jj AS (SELECT seq_id, ids, {MARKPOS_SQL} AS j FROM enc, mk)
SELECT seq_id, j AS marker_pos, array_to_string({mask_sql('ids')}, ',') AS mask FROM jj
""")
def a2(spark, sf):
    e = encoded(spark, sf)
    return e.select("seq_id", tokens.marker_position(F.col("ids"), F.col("marker"), M).alias("marker_pos"),
                    js(tokens.loss_mask_marker(F.col("ids"), F.col("marker"), M)).alias("mask"))


@register("a3_labels_prompt_cut", TOK_SQL + " SELECT seq_id, array_to_string(labels, ',') AS labels FROM lab")
def a3(spark, sf):
    e = encoded(spark, sf)
    return e.select("seq_id", js(tokens.labels_prompt_cut(F.col("ids"), F.col("prompt_len"))).alias("labels"))


@register("a4_labels_copy", TOK_SQL + " SELECT seq_id, array_to_string(ids, ',') AS labels FROM enc")
def a4(spark, sf):
    return encoded(spark, sf).select("seq_id", js(tokens.labels_copy(F.col("ids"))).alias("labels"))


@register("a5_attention_mask", TOK_SQL + """
SELECT seq_id, batch, array_to_string(list_transform(ids, lambda x: CASE WHEN x <> 0 THEN 1 ELSE 0 END), ',') AS attention_mask FROM pad
""")
def a5(spark, sf):
    b = batched(spark, sf)
    return b.select("seq_id", "batch", js(tokens.attention_mask(F.col("ids"))).alias("attention_mask"))


@register("a6_shift_align", TOK_SQL + f""",
jj AS (SELECT seq_id, ids, labels, {MARKPOS_SQL} AS j FROM lab, mk),
mm AS (SELECT seq_id, ids, labels, {mask_sql('ids')} AS mask FROM jj)
SELECT seq_id, array_to_string(ids[1:greatest(len(ids) - 1, 0)], ',') AS inputs,
       array_to_string(labels[2:greatest(len(ids) - 1, 0) + 1], ',') AS labels,
       array_to_string(mask[2:greatest(len(ids) - 1, 0) + 1], ',') AS mask
FROM mm
""")
def a6(spark, sf):
    e = encoded(spark, sf)
    labels = tokens.labels_prompt_cut(F.col("ids"), F.col("prompt_len"))
    mask = tokens.loss_mask_marker(F.col("ids"), F.col("marker"), M)
    i, l, m = tokens.shift_align(F.col("ids"), labels, mask)
    return e.select("seq_id", js(i).alias("inputs"), js(l).alias("labels"), js(m).alias("mask"))


@register("a7_pad_batch", TOK_SQL + """
SELECT seq_id, batch, array_to_string(ids, ',') AS ids, array_to_string(labels, ',') AS labels FROM pad
""")
def a7(spark, sf):
    b = batched(spark, sf)
    return b.select("seq_id", "batch", js("ids").alias("ids"), js("labels").alias("labels"))


@register("w4_assign_batches", TOK_SQL + " SELECT seq_id, batch FROM bat")
def w4(spark, sf):
    return tokens.assign_batches(sequences(spark, sf).select("seq_id"), "seq_id", BATCH, SEED)


@register("g10_masked_mean_loss", TOK_SQL + f""",
jj AS (SELECT p.seq_id, p.batch, p.ids, {MARKPOS_SQL} AS j FROM pad p, mk),
mm AS (SELECT batch, ids[2:] AS lab, ({mask_sql('ids')})[2:] AS mask FROM jj),
z AS (SELECT batch, unnest(list_transform(lab, lambda x: CASE WHEN x = 0 THEN 0.0 ELSE (x % 7) / 7.0 END)) AS l,
             unnest(mask) AS m FROM mm)
SELECT batch, round(sum(l * m) / (sum(m) + 1e-8), 6) AS masked_loss FROM z GROUP BY batch
""")
def g10(spark, sf):
    """The sums of each sequence are formed before anything is shuffled, so no token travels. A mask reaches over the padding
    (A2) where the loss is 0: it adds the batch's width less the sequence's length to the mask's sum."""
    e = encoded(spark, sf)
    at = tokens.marker_position(F.col("ids"), F.col("marker"), M)
    e = e.withColumn("at", at)
    n = F.greatest(F.size("ids") - 1, F.lit(0))
    loss = F.transform(F.slice(F.col("ids"), 2, n), lambda x: F.when(x == tokens.PAD_ID, F.lit(0.0)).otherwise((x % 7) / 7.0))
    sums = tokens.masked_sums(loss, F.slice(tokens.mask_from_position(F.col("ids"), F.col("at"), M), 2, n))
    narrow = e.select("seq_id", F.size("ids").alias("size"), F.col("at").isNotNull().alias("found"), sums[0].alias("loss"), sums[1].alias("mask"))
    b = tokens.assign_batches(narrow, "seq_id", BATCH, SEED)
    width = F.max("size").over(Window.partitionBy("batch"))  # a batch has at most BATCH rows
    s = b.select("batch", "loss", (F.col("mask") + F.when(F.col("found"), width - F.col("size")).otherwise(0)).alias("mask"))
    out = tokens.masked_mean_loss(s, ["batch"], "loss", "mask")
    return out.select("batch", r6("masked_loss", 6).alias("masked_loss"))


@register("a8_pack_sequences", TOK_SQL + f""",
b AS (SELECT CAST(CAST('0x' || substr(md5(CAST(seq_id AS VARCHAR)), 1, 8) AS BIGINT) % {BUCKETS} AS BIGINT) AS bucket, seq_id, ids FROM enc),
e AS (SELECT bucket, seq_id, unnest(ids) AS id, generate_subscripts(ids, 1) AS i FROM b),
n AS (SELECT bucket, id, row_number() OVER (PARTITION BY bucket ORDER BY seq_id, i) - 1 AS pos FROM e)
SELECT bucket, pos // {MAX_LEN} AS chunk, CAST(count(*) AS INTEGER) AS n_tokens, md5(string_agg(CAST(id AS VARCHAR), ',' ORDER BY pos)) AS ids_md5
FROM n GROUP BY bucket, pos // {MAX_LEN}
""")
def a8(spark, sf):
    p = tokens.pack_sequences(encoded(spark, sf), "seq_id", "ids", MAX_LEN, BUCKETS)
    return p.select("bucket", F.col("chunk").cast("long").alias("chunk"), F.size("packed").alias("n_tokens"), F.md5(js("packed")).alias("ids_md5"))
