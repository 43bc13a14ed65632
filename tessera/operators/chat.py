"""Chat templates and training rows (C1-C7, C11 helpers, M1).

Input is the long dialog table ``conv_id, turn, role, text``; ``turn`` orders a dialog and
may start anywhere and leave numbers out. "Next turn" goes over a global index of the keys, so
even a dialog holding a third of all rows is spread over every task (a ``lead`` window would
put it in one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordering import join_same, neighbour, settled, with_global_index
from tessera.functions.text import IM_END, IM_START, ensure_question_mark, ustrip

NL = "\n"
ASSISTANT_HEADER = IM_START + "assistant" + NL


def chatml_piece(role, text):
    """``<|im_start|>role\\ncontent<|im_end|>\\n`` for one turn."""
    return F.concat(F.lit(IM_START), role, F.lit(NL), text, F.lit(IM_END), F.lit(NL))


def chatml_render(turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
                  role: str = "role", text: str = "text") -> DataFrame:
    """One ChatML text per dialog, turns in order, no generation prompt.

    The rendered string is the output itself, so the dialog is gathered into one
    row; pieces are built before the shuffle so only strings travel.
    """
    pieces = turns.select(F.col(conv), F.struct(F.col(turn).alias("t"),
                                                chatml_piece(F.col(role), F.col(text)).alias("p")).alias("tp"))
    return (pieces.groupBy(conv)
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list("tp")), lambda x: x["p"]), "")
                 .alias("rendered")))


def chatml_prompt(turns: DataFrame, **kw) -> DataFrame:
    """C1 followed by the assistant header (generation prompt)."""
    return chatml_render(turns, **kw).select(
        "conv_id", F.concat(F.col("rendered"), F.lit(ASSISTANT_HEADER)).alias("prompt"))


def next_turn(turns: DataFrame, cols=("role", "text")) -> DataFrame:
    """Attach ``next_<col>`` of the dialog's next row by turn (``lead``), whatever the numbers leave out.

    Only the keys are put in order and numbered (a global index, see ``ordering``); the next row is then
    fetched by its unique key (conv_id, turn), so a hot dialog is spread over every task.
    """
    keys = with_global_index(turns.select("conv_id", "turn"), [F.col("conv_id"), F.col("turn")], "_g")
    nxt = neighbour(keys, ["conv_id"], ["turn"], -1, index="_g", prefix="_next_").select(
        F.col("conv_id").alias("_kc"), F.col("turn").alias("_kt"), "_next_turn")
    other = turns.select(F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), *[F.col(c).alias("next_" + c) for c in cols])
    placed = turns.join(nxt, turns["conv_id"].eqNullSafe(F.col("_kc")) & (turns["turn"] == F.col("_kt")), "left")
    return (placed.join(other, placed["conv_id"].eqNullSafe(other["_c"]) & (placed["_next_turn"] == other["_t"]), "left")
            .drop("_c", "_t", "_kc", "_kt", "_next_turn"))


def user_assistant_pairs(turns: DataFrame) -> DataFrame:
    """User turns directly followed by an assistant turn: conv_id, turn, question, answer."""
    j = next_turn(turns)
    return (j.where((F.col("role") == "user") & (F.col("next_role") == "assistant"))
            .select("conv_id", "turn", F.col("text").alias("question"), F.col("next_text").alias("answer")))


def to_prompt_completion(turns: DataFrame) -> DataFrame:
    """prompt = user turn + assistant header; completion = answer + end mark."""
    p = user_assistant_pairs(turns)
    return p.select(
        "conv_id", "turn",
        F.concat(F.lit(IM_START + "user" + NL), F.col("question"), F.lit(IM_END + NL + ASSISTANT_HEADER)).alias("prompt"),
        F.concat(F.col("answer"), F.lit(IM_END)).alias("completion"))


def to_multiturn_samples(turns: DataFrame) -> DataFrame:
    """C4: one sample per assistant turn; the whole history before it goes into the prompt.

    One sorted array of rendered pieces per dialog, then a filter per assistant turn,
    instead of a growing window frame (less state for long dialogs). History is what has a smaller
    turn number, wherever the numbering starts and whatever it leaves out.
    """
    pieces = turns.select("conv_id", "turn", "role", "text",
                          chatml_piece(F.col("role"), F.col("text")).alias("piece"))
    hist = (pieces.groupBy("conv_id")
            .agg(F.array_sort(F.collect_list(F.struct("turn", "piece"))).alias("pieces")))
    answers = pieces.where(F.col("role") == "assistant").select("conv_id", "turn", "text")
    return (join_same(answers, settled(hist), ["conv_id"])
            .select("conv_id", "turn",
                    F.concat(F.array_join(F.transform(F.filter("pieces", lambda x: x["turn"] < F.col("turn")),
                                                      lambda x: x["piece"]), ""),
                             F.lit(ASSISTANT_HEADER)).alias("prompt"),
                    F.concat(F.col("text"), F.lit(IM_END)).alias("completion")))


def inject_system(turns: DataFrame, system_text: str) -> DataFrame:
    """Dialogs without a system turn get one at turn -1 (so it sorts first)."""
    missing = (turns.groupBy("conv_id")
               .agg(F.max((F.col("role") == "system").cast("int")).alias("_has"))
               .where(F.col("_has") == 0)
               .select("conv_id", F.lit(-1).cast("long").alias("turn"), F.lit("system").alias("role"),
                       F.lit(system_text).alias("text")))
    return turns.select("conv_id", "turn", "role", "text").unionByName(missing)


def to_query_only(turns: DataFrame) -> DataFrame:
    """RL prompts with no answer: PPO query in ChatML and bare GRPO prompt."""
    return (turns.where(F.col("role") == "user")
            .select("conv_id", "turn",
                    F.concat(F.lit(IM_START + "user" + NL), F.col("text"),
                             F.lit(IM_END + NL + ASSISTANT_HEADER)).alias("query"),
                    F.col("text").alias("prompt")))


def expand_variants(base: DataFrame, id_col: str = "base_id", variants: str = "variants",
                    answer: str = "answer") -> DataFrame:
    """Each non-blank string of the variant array becomes a row sharing the answer.

    Blanks are dropped after a strip; an empty array yields nothing (the base
    question itself is not written). T9 is applied to every question.
    """
    return (base.select(id_col, answer, F.posexplode(F.col(variants)).alias("pos", "_q"))
            .withColumn("_q", ustrip(F.col("_q")))
            .where(F.col("_q").isNotNull() & (F.length("_q") > 0))
            .select(id_col, "pos", ensure_question_mark(F.col("_q")).alias("question"),
                    F.col(answer).alias("answer")))


def require_fields(df: DataFrame, cols: list[str]) -> DataFrame:
    """Strip the required fields and drop rows where any is null or empty."""
    out = df
    for c in cols:
        out = out.withColumn(c, ustrip(F.col(c)))
    cond = None
    for c in cols:
        ok = F.col(c).isNotNull() & (F.length(F.col(c)) > 0)
        cond = ok if cond is None else cond & ok
    return out.where(cond)


def episodic_rows(turns: DataFrame) -> DataFrame:
    """M1: one memory text per exchange: ``User: …\\nAssistant: …``."""
    p = user_assistant_pairs(turns)
    return p.select("conv_id", "turn",
                    F.concat(F.lit("User: "), F.col("question"), F.lit("\nAssistant: "), F.col("answer"))
                    .alias("memory"))
