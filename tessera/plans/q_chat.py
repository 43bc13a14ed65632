"""Chat-template queries over the dialog table (fixture F1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import count_keywords, ensure_question_mark, extract_reply
from tessera.operators import chat
from tessera.operators.dedup import first_per_key
from tessera.plans.registry import register
from tessera.plans.sqlkit import PAIRS_CTE, PC_CTE, kw_hits, piece, strip
from tessera.sources.tables import table

SYSTEM_TEXT = "You are a helpful assistant."
BLANK_VARIANTS = ["", "   "]


def conversations(spark, sf) -> DataFrame:
    return table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")


def variant_base(spark, sf) -> DataFrame:
    """C7 input: per dialog, its user turns as paraphrase array plus literal blanks;
    base answer = first assistant turn."""
    t = conversations(spark, sf)
    users = (t.where(F.col("role") == "user").groupBy("conv_id")
             .agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"])
                  .alias("_u")))
    answers = (t.where(F.col("role") == "assistant").groupBy("conv_id")
               .agg(F.min_by("text", "turn").alias("answer")))
    return (users.join(answers, "conv_id", "left")
            .select(F.col("conv_id").alias("base_id"), "answer",
                    F.concat(F.col("_u"), F.array(*[F.lit(b) for b in BLANK_VARIANTS])).alias("variants")))


VARIANTS_SQL = f"""
variants AS (
  SELECT u.conv_id AS base_id, a.answer, u.pos, u.q
  FROM (SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS pos, text AS q
        FROM conversations WHERE role = 'user') u
  LEFT JOIN (SELECT conv_id, arg_min(text, turn) AS answer FROM conversations WHERE role = 'assistant' GROUP BY conv_id) a
    ON a.conv_id = u.conv_id),
expanded AS (
  SELECT base_id, pos,
         CASE WHEN regexp_matches({strip('q')}, '[?？]$') THEN {strip('q')} ELSE {strip('q')} || '？' END AS question,
         answer
  FROM variants WHERE length({strip('q')}) > 0)
"""


@register("c1_chatml_render", f"""
SELECT conv_id, string_agg({piece('role', 'text')}, '' ORDER BY turn) AS rendered
FROM conversations GROUP BY conv_id
""")
def c1(spark, sf):
    return chat.chatml_render(conversations(spark, sf))


@register("c2_chatml_prompt", f"""
SELECT conv_id, string_agg({piece('role', 'text')}, '' ORDER BY turn) || '<|im_start|>assistant' || chr(10) AS prompt
FROM conversations GROUP BY conv_id
""")
def c2(spark, sf):
    return chat.chatml_prompt(conversations(spark, sf))


@register("c3_to_prompt_completion", "WITH " + PC_CTE + " SELECT conv_id, turn, prompt, completion FROM pc")
def c3(spark, sf):
    return chat.to_prompt_completion(conversations(spark, sf))


@register("c4_to_multiturn_samples", f"""
WITH h AS (
  SELECT conv_id, turn, role, text,
         coalesce(string_agg({piece('role', 'text')}, '') OVER (PARTITION BY conv_id ORDER BY turn
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS hist
  FROM conversations)
SELECT conv_id, turn, hist || '<|im_start|>assistant' || chr(10) AS prompt, text || '<|im_end|>' AS completion
FROM h WHERE role = 'assistant'
""")
def c4(spark, sf):
    return chat.to_multiturn_samples(conversations(spark, sf))


@register("c5_inject_system", f"""
SELECT conv_id, turn, role, text FROM conversations
UNION ALL
SELECT conv_id, CAST(-1 AS BIGINT) AS turn, 'system' AS role, '{SYSTEM_TEXT}' AS text
FROM conversations GROUP BY conv_id HAVING max(CASE WHEN role = 'system' THEN 1 ELSE 0 END) = 0
""")
def c5(spark, sf):
    return chat.inject_system(conversations(spark, sf), SYSTEM_TEXT)


@register("c6_to_query_only", """
SELECT conv_id, turn,
       '<|im_start|>user' || chr(10) || text || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) AS query,
       text AS prompt
FROM conversations WHERE role = 'user'
""")
def c6(spark, sf):
    return chat.to_query_only(conversations(spark, sf))


@register("c7_expand_variants", "WITH " + VARIANTS_SQL + " SELECT base_id, pos, question, answer FROM expanded")
def c7(spark, sf):
    return chat.expand_variants(variant_base(spark, sf))


@register("d2_dedup_questions", "WITH " + VARIANTS_SQL + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY question ORDER BY base_id, pos) AS rn FROM expanded)
SELECT question, answer, base_id, pos FROM ranked WHERE rn = 1
""")
def d2(spark, sf):
    rows = chat.expand_variants(variant_base(spark, sf))
    return first_per_key(rows, ["question"], ["base_id", "pos"], ["answer"]).select(
        "question", "answer", "base_id", "pos")


@register("p1_require_fields", "WITH " + PAIRS_CTE + f"""
SELECT conv_id, turn, {strip('question')} AS question, {strip('answer')} AS answer FROM pairs
WHERE length({strip('question')}) > 0 AND length({strip('answer')}) > 0
""")
def p1(spark, sf):
    return chat.require_fields(chat.user_assistant_pairs(conversations(spark, sf)), ["question", "answer"])


@register("p2_project_only", "WITH " + PC_CTE + " SELECT prompt, completion FROM pc")
def p2(spark, sf):
    return chat.to_prompt_completion(conversations(spark, sf)).select("prompt", "completion")


@register("t9_ensure_question_mark", """
SELECT conv_id, turn, CASE WHEN regexp_matches(text, '[?？]$') THEN text ELSE text || '？' END AS question
FROM conversations WHERE role = 'user'
""")
def t9(spark, sf):
    t = conversations(spark, sf).where(F.col("role") == "user")
    return t.select("conv_id", "turn", ensure_question_mark(F.col("text")).alias("question"))


@register("t10_extract_reply", f"""
WITH r AS (
  SELECT conv_id, string_agg({piece('role', 'text')}, '' ORDER BY turn) AS rendered,
         arg_min(CASE WHEN role = 'user' THEN text END, CASE WHEN role = 'user' THEN turn END) AS first_user
  FROM conversations GROUP BY conv_id)
SELECT conv_id,
  CASE WHEN strpos(rendered, '<|im_start|>assistant') > 0
       THEN {strip("replace(string_split(rendered, '<|im_start|>assistant')[-1], '<|im_end|>', '')")}
       ELSE {strip("replace(rendered, first_user, '')")} END AS reply_ppo,
  CASE WHEN strpos(rendered, '<|im_start|>assistant' || chr(10)) > 0
       THEN string_split(string_split(rendered, '<|im_start|>assistant' || chr(10))[-1], '<|im_end|>')[1]
       ELSE replace(replace(rendered, '<|im_start|>', ''), '<|im_end|>', '') END AS reply_trl
FROM r
""")
def t10(spark, sf):
    t = conversations(spark, sf)
    r = (t.groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", chat.chatml_piece(
            F.col("role"), F.col("text")).alias("p")))), lambda x: x["p"]), "").alias("rendered"),
        F.min_by(F.when(F.col("role") == "user", F.col("text")),
                 F.when(F.col("role") == "user", F.col("turn"))).alias("first_user")))
    return r.select("conv_id",
                    extract_reply(F.col("rendered"), "ppo", F.col("first_user")).alias("reply_ppo"),
                    extract_reply(F.col("rendered"), "trl").alias("reply_trl"))


@register("t11_contains_keywords", f"""
SELECT conv_id, turn, CAST({kw_hits('text')} AS INTEGER) AS hits FROM conversations WHERE role = 'assistant'
""")
def t11(spark, sf):
    from tessera.plans.sqlkit import KEYWORDS
    t = conversations(spark, sf).where(F.col("role") == "assistant")
    return t.select("conv_id", "turn", count_keywords(F.col("text"), KEYWORDS).cast("int").alias("hits"))


@register("m1_episodic_rows", "WITH " + PAIRS_CTE + """
SELECT conv_id, turn, 'User: ' || question || chr(10) || 'Assistant: ' || answer AS memory FROM pairs
""")
def m1(spark, sf):
    return chat.episodic_rows(conversations(spark, sf))
