"""Rule-based rewards, group-relative advantages and preference pairs.

Every reward is a projection (no shuffle). Group statistics are partial
aggregates joined back on the group key, so a prompt with a huge number of
completions is combined map-side instead of being sorted in one task; AQE turns
the join back into a broadcast when the statistics table is small at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import IM_END, IM_START, count_keywords, regex_quote
from tessera.operators.ordering import join_same, settled


def reward_length(text) -> Column:
    """Number of characters as a double (the code counts characters, not tokens)."""
    return F.length(text).cast("double")


def reward_keywords(text, words: list[str]) -> Column:
    """R2: min(hits / number of keywords, 1)."""
    return F.least(count_keywords(text, words) / F.lit(float(len(words))), F.lit(1.0))


def reward_format(text) -> Column:
    """Both markers present -> 1.0 if the counts agree else 0.5; otherwise 0.0."""
    starts = F.regexp_count(text, F.lit(regex_quote(IM_START)))
    ends = F.regexp_count(text, F.lit(regex_quote(IM_END)))
    return (F.when((starts > 0) & (ends > 0), F.when(starts == ends, 1.0).otherwise(0.5))
            .otherwise(0.0))


def reward_total(df: DataFrame, columns: list[str], weights: list[float] | None = None,
                 name: str = "reward") -> DataFrame:
    """Weighted sum of reward columns; equal weights when none are given."""
    weights = weights or [1.0] * len(columns)
    total = F.lit(0.0)
    for c, w in zip(columns, weights):
        total = total + F.col(c) * F.lit(float(w))
    return df.withColumn(name, total)


def missing_eos_penalty(reward, text, penalty: float = 1.0) -> Column:
    """Subtract ``penalty`` when the completion has no end mark."""
    return F.when(F.instr(text, IM_END) > 0, reward).otherwise(reward - F.lit(penalty))


def ranking_loss(margin) -> Column:
    """-log(sigmoid(m)) in a form that does not overflow for either sign."""
    m = margin
    return F.when(m >= 0, F.log1p(F.exp(-m))).otherwise(-m + F.log1p(F.exp(m)))


def group_advantage(df: DataFrame, group: list[str], reward: str = "reward",
                    eps: float = 1e-4, name: str = "advantage") -> DataFrame:
    """(r - mean_group) / (std_samp_group + eps); a group of one gives 0."""
    stats = settled(df.groupBy(*group).agg(F.avg(reward).alias("_mean"), F.stddev_samp(reward).alias("_std"),
                                           F.count(F.lit(1)).alias("_n")))
    return (join_same(df, stats, group)
            .withColumn(name, F.when(F.col("_n") < 2, F.lit(0.0))
                        .otherwise((F.col(reward) - F.col("_mean")) / (F.col("_std") + F.lit(eps))))
            .drop("_mean", "_std", "_n"))


def best_per_group(df: DataFrame, group: list[str], score: str, tiebreak: str, cols: list[str]) -> DataFrame:
    """Row with the highest score per group (ties: smallest ``tiebreak``) via ``max_by``.

    ``max_by`` is a partial aggregate: a hot group is reduced map-side.
    """
    key = F.struct(F.col(score), (-F.col(tiebreak)).alias("_tb"))
    payload = F.struct(*[F.col(c) for c in cols])
    return (df.groupBy(*group).agg(F.max_by(payload, key).alias("_best"))
            .select(*group, *[F.col("_best")[c].alias(c) for c in cols]))


def preference_pairs(completions: DataFrame, prompt: str, reply: str, order: list[str], score: str) -> DataFrame:
    """Best vs worst completion of the same prompt, wherever it was asked; full ChatML text on both sides.

    ``max_by``/``min_by`` over the prompt's text give the pair without a self join, a frequent prompt is reduced
    map-side. Ties of the score go to the smaller ``order``; for the worst, too. Prompts whose completions all score
    alike give no pair (there is nothing to prefer), nor do null prompts; null replies or scores take no part.
    """
    at = F.struct(*order)
    usable = completions.where(F.col(prompt).isNotNull() & F.col(reply).isNotNull() & F.col(score).isNotNull())
    ranked = usable.select(F.col(prompt).alias("_p"), F.struct(F.col(score).alias("s"), at.alias("o"), F.col(reply).alias("r")).alias("_c"))
    low = F.min_by("_c", F.struct("_c.s", "_c.o"))
    high = F.min_by("_c", F.struct((-F.col("_c.s")).alias("s"), "_c.o"))
    g = ranked.groupBy("_p").agg(high.alias("_hi"), low.alias("_lo")).where("_hi.s > _lo.s")

    def full(p, r):
        return F.concat(p, r, F.lit(IM_END))

    origin = [F.col(f"_{side}.o.{c}").alias(f"{name}_{c}") for side, name in (("hi", "chosen"), ("lo", "rejected")) for c in order]
    return g.select(F.col("_p").alias("prompt"), full(F.col("_p"), F.col("_hi.r")).alias("chosen"),
                    full(F.col("_p"), F.col("_lo.r")).alias("rejected"), *origin)


def pairwise_eval(pairs: DataFrame, chosen_score: str, rejected_score: str) -> DataFrame:
    """Share of pairs with score(chosen) > score(rejected) (ties are wrong), mean margin."""
    return pairs.agg(
        F.avg((F.col(chosen_score) > F.col(rejected_score)).cast("double")).alias("accuracy"),
        F.avg(F.col(chosen_score) - F.col(rejected_score)).alias("mean_margin"),
        F.count(F.lit(1)).alias("n_pairs"))
