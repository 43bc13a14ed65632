"""Reward, advantage and preference queries (F1), plus the flagship slice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.numeric import r6

from tessera.functions.text import IM_END, IM_START
from tessera.operators import chat, rewards
from tessera.operators.plugins import with_user_rewards
from tessera.plans.q_chat import conversations
from tessera.plans.registry import register
from tessera.plans.sqlkit import KEYWORDS, PAIRS_CTE, PC_CTE, fmt_reward, kw_reward

LEN_WEIGHT = 0.01
EPS = 1e-4


def scored_completions(spark, sf) -> DataFrame:
    """C3 completions with R1, R2, R3 and the weighted total R4."""
    pc = chat.to_prompt_completion(conversations(spark, sf))
    full = F.concat(F.col("prompt"), F.col("completion"))
    s = pc.select("conv_id", "turn", "prompt", "completion",
                  rewards.reward_length(F.col("completion")).alias("r_len"),
                  rewards.reward_keywords(F.col("completion"), KEYWORDS).alias("r_kw"),
                  rewards.reward_format(full).alias("r_fmt"))
    return rewards.reward_total(s, ["r_len", "r_kw", "r_fmt"], [LEN_WEIGHT, 1.0, 1.0])


SCORED_SQL = "WITH " + PC_CTE + f""",
s AS (
  SELECT conv_id, turn, prompt, completion, CAST(length(completion) AS DOUBLE) AS r_len,
         {kw_reward('completion')} AS r_kw, {fmt_reward('prompt || completion')} AS r_fmt
  FROM pc),
scored AS (SELECT *, 0.0 + r_len * {LEN_WEIGHT} + r_kw * 1.0 + r_fmt * 1.0 AS reward FROM s),
adv AS (
  SELECT *, CASE WHEN count(*) OVER g < 2 THEN 0.0
                 ELSE (reward - avg(reward) OVER g) / (stddev_samp(reward) OVER g + {EPS}) END AS advantage
  FROM scored WINDOW g AS (PARTITION BY conv_id))
"""


def advantages(spark, sf) -> DataFrame:
    return rewards.group_advantage(scored_completions(spark, sf), ["conv_id"], "reward", EPS)


@register("grpo_best_completion", SCORED_SQL + """,
best AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY reward DESC, turn) AS rn FROM adv)
SELECT conv_id, turn, round(reward, 6) AS reward, round(advantage, 6) AS advantage, completion
FROM best WHERE rn = 1
""")
def grpo_best_completion(spark, sf):
    """Flagship: dialogs -> prompt/completion -> rewards -> group advantage -> best per group."""
    a = advantages(spark, sf)
    best = rewards.best_per_group(a, ["conv_id"], "reward", "turn", ["turn", "reward", "advantage", "completion"])
    return best.select("conv_id", "turn", r6("reward", 6).alias("reward"),
                       r6("advantage", 6).alias("advantage"), "completion")


@register("r1_reward_length", SCORED_SQL + " SELECT conv_id, turn, r_len FROM scored")
def r1(spark, sf):
    return scored_completions(spark, sf).select("conv_id", "turn", "r_len")


@register("r2_reward_keywords", SCORED_SQL + " SELECT conv_id, turn, round(r_kw, 6) AS r_kw FROM scored")
def r2(spark, sf):
    return scored_completions(spark, sf).select("conv_id", "turn", r6("r_kw", 6).alias("r_kw"))


@register("r3_reward_format", "WITH " + PC_CTE + f"""
SELECT conv_id, turn, {fmt_reward('completion')} AS fmt_completion, {fmt_reward('prompt')} AS fmt_prompt,
       {fmt_reward('prompt || completion')} AS fmt_full FROM pc
""")
def r3(spark, sf):
    pc = chat.to_prompt_completion(conversations(spark, sf))
    return pc.select("conv_id", "turn",
                     rewards.reward_format(F.col("completion")).alias("fmt_completion"),
                     rewards.reward_format(F.col("prompt")).alias("fmt_prompt"),
                     rewards.reward_format(F.concat("prompt", "completion")).alias("fmt_full"))


@register("r4_reward_total", SCORED_SQL + " SELECT conv_id, turn, round(reward, 6) AS reward FROM scored")
def r4(spark, sf):
    return scored_completions(spark, sf).select("conv_id", "turn", r6("reward", 6).alias("reward"))


def length_reward(completions: list[str]) -> list[float]:
    return [float(len(c)) for c in completions]


def keyword_reward(completions: list[str]) -> list[float]:
    return [min(sum(w in c for w in KEYWORDS) / len(KEYWORDS), 1.0) for c in completions]


def format_reward(prompts: list[str], completions: list[str]) -> list[float]:
    texts = [p + c for p, c in zip(prompts, completions)]
    marks = [(t.count(IM_START), t.count(IM_END)) for t in texts]
    return [(1.0 if s == e else 0.5) if s and e else 0.0 for s, e in marks]


@register("r4_user_rewards", SCORED_SQL + " SELECT conv_id, turn, round(reward, 6) AS reward FROM scored")
def r4_user(spark, sf):
    """R4 with the three rewards as a user's Python functions over Arrow batches."""
    pc = chat.to_prompt_completion(conversations(spark, sf))
    completions = {"completions": F.col("completion")}
    scored = with_user_rewards(pc, {"r_len": (length_reward, completions), "r_kw": (keyword_reward, completions),
                                    "r_fmt": (format_reward, {"prompts": F.col("prompt"), **completions})},
                               {"r_len": LEN_WEIGHT, "r_kw": 1.0, "r_fmt": 1.0})
    return scored.select("conv_id", "turn", r6("reward", 6).alias("reward"))


@register("r6_missing_eos_penalty", f"""
SELECT conv_id, turn,
       round({kw_reward('text')} - CASE WHEN strpos(text, '<|im_end|>') > 0 THEN 0.0 ELSE 1.0 END, 6) AS pen_raw,
       round({kw_reward("text || '<|im_end|>'")} - CASE WHEN strpos(text || '<|im_end|>', '<|im_end|>') > 0 THEN 0.0 ELSE 1.0 END, 6) AS pen_completion
FROM conversations WHERE role = 'assistant'
""")
def r6_penalty(spark, sf):
    t = conversations(spark, sf).where(F.col("role") == "assistant")
    comp = F.concat(F.col("text"), F.lit("<|im_end|>"))
    return t.select("conv_id", "turn",
                    r6(rewards.missing_eos_penalty(rewards.reward_keywords(F.col("text"), KEYWORDS),
                                                        F.col("text")), 6).alias("pen_raw"),
                    r6(rewards.missing_eos_penalty(rewards.reward_keywords(comp, KEYWORDS), comp), 6)
                    .alias("pen_completion"))


@register("w5_group_advantage", SCORED_SQL + """
SELECT conv_id, turn, round(reward, 6) AS reward, round(advantage, 6) AS advantage FROM adv
""")
def w5(spark, sf):
    a = advantages(spark, sf)
    return a.select("conv_id", "turn", r6("reward", 6).alias("reward"), r6("advantage", 6).alias("advantage"))


def pair_candidates(spark, sf) -> DataFrame:
    """Two completions of every user turn's own prompt: the reply, and its first line as a shorter draft (stand-in for
    several generations per prompt; the table holds one)."""
    pc = chat.user_assistant_pairs(conversations(spark, sf)).select(
        "conv_id", "turn", F.concat(F.lit(IM_START + "user\n"), F.col("question"), F.lit(IM_END + "\n" + IM_START + "assistant\n")).alias("prompt"), "answer")
    drafts = F.array(F.struct(F.lit(0).alias("variant"), F.col("answer").alias("reply")),
                     F.struct(F.lit(1).alias("variant"), F.substring_index("answer", "\n", 1).alias("reply")))
    return pc.select("conv_id", "turn", "prompt", F.inline(drafts)).withColumn("reply_len", F.length("reply"))


PAIRS_SQL = "WITH " + PAIRS_CTE + """,
c AS (
  SELECT conv_id, turn, '<|im_start|>user' || chr(10) || question || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) AS prompt,
         v AS variant, CASE WHEN v = 0 THEN answer ELSE string_split(answer, chr(10))[1] END AS reply
  FROM pairs, (VALUES (0), (1)) d(v)),
rk AS (
  SELECT *, row_number() OVER (PARTITION BY prompt ORDER BY length(reply) DESC, conv_id, turn, variant) AS hi,
            row_number() OVER (PARTITION BY prompt ORDER BY length(reply), conv_id, turn, variant) AS lo FROM c),
chosen_pairs AS (
  SELECT h.prompt, h.prompt || h.reply || '<|im_end|>' AS chosen, h.prompt || l.reply || '<|im_end|>' AS rejected,
         h.conv_id AS chosen_conv_id, h.turn AS chosen_turn, h.variant AS chosen_variant,
         l.conv_id AS rejected_conv_id, l.turn AS rejected_turn, l.variant AS rejected_variant,
         h.reply AS chosen_reply, l.reply AS rejected_reply
  FROM rk h JOIN rk l ON l.prompt = h.prompt AND l.lo = 1 WHERE h.hi = 1 AND length(h.reply) > length(l.reply))
"""


def preference_pairs(spark, sf) -> DataFrame:
    return rewards.preference_pairs(pair_candidates(spark, sf), "prompt", "reply", ["conv_id", "turn", "variant"], "reply_len")


@register("j3_preference_pairs", PAIRS_SQL + """
SELECT prompt, chosen, rejected, chosen_conv_id, chosen_turn, chosen_variant, rejected_conv_id, rejected_turn, rejected_variant FROM chosen_pairs
""")
def j3(spark, sf):
    return preference_pairs(spark, sf)


def _pair_scores(spark, sf) -> DataFrame:
    p = preference_pairs(spark, sf)
    reply = lambda c: F.regexp_extract(F.col(c), r"(?s)<\|im_start\|>assistant\n(.*)<\|im_end\|>$", 1)
    return p.select(F.col("chosen_conv_id").alias("conv_id"), rewards.reward_keywords(reply("chosen"), KEYWORDS).alias("s_chosen"),
                    rewards.reward_keywords(reply("rejected"), KEYWORDS).alias("s_rejected"))


@register("r5_ranking_loss", PAIRS_SQL + f""",
sc AS (SELECT chosen_conv_id AS conv_id, {kw_reward('chosen_reply')} - {kw_reward('rejected_reply')} AS margin FROM chosen_pairs)
SELECT conv_id, round(margin, 6) AS margin,
       round(CASE WHEN margin >= 0 THEN ln(1 + exp(-margin)) ELSE -margin + ln(1 + exp(margin)) END, 6) AS loss
FROM sc
""")
def r5(spark, sf):
    s = _pair_scores(spark, sf).withColumn("margin", F.col("s_chosen") - F.col("s_rejected"))
    return s.select("conv_id", r6("margin", 6).alias("margin"),
                    r6(rewards.ranking_loss(F.col("margin")), 6).alias("loss"))


@register("g11_pairwise_eval", PAIRS_SQL + f""",
sc AS (SELECT {kw_reward('chosen_reply')} AS s_chosen, {kw_reward('rejected_reply')} AS s_rejected FROM chosen_pairs)
SELECT round(avg(CASE WHEN s_chosen > s_rejected THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       round(avg(s_chosen - s_rejected), 6) AS mean_margin, count(*) AS n_pairs FROM sc
""")
def g11(spark, sf):
    e = rewards.pairwise_eval(_pair_scores(spark, sf), "s_chosen", "s_rejected")
    return e.select(r6("accuracy", 6).alias("accuracy"), r6("mean_margin", 6).alias("mean_margin"), "n_pairs")
