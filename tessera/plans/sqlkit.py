"""SQL text fragments shared by the DuckDB oracles.

They spell out, in plain SQL, the same fixture derivations the Spark side builds
with the DataFrame API (FIXTURES.md F1-F8).
"""

from __future__ import annotations

from tessera.functions.text import WS_CLASS

NL = "chr(10)"
KEYWORDS = ["que", "der", "the", "le", "en", "la", "und", "to"]


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS_CLASS}+|{WS_CLASS}+$', '', 'g')"


def collapse(x: str) -> str:
    return f"regexp_replace({x}, '{WS_CLASS}+', ' ', 'g')"


def piece(role: str, text: str) -> str:
    return f"('<|im_start|>' || {role} || {NL} || {text} || '<|im_end|>' || {NL})"


def kw_hits(x: str, words=KEYWORDS) -> str:
    return "(" + " + ".join(f"(CASE WHEN strpos({x}, '{w}') > 0 THEN 1 ELSE 0 END)" for w in words) + ")"


def kw_reward(x: str, words=KEYWORDS) -> str:
    return f"least({kw_hits(x, words)} / {float(len(words))}, 1.0)"


def count_sub(x: str, sub: str) -> str:
    return f"((length({x}) - length(replace({x}, '{sub}', ''))) // length('{sub}'))"


def fmt_reward(x: str) -> str:
    s, e = count_sub(x, "<|im_start|>"), count_sub(x, "<|im_end|>")
    return (f"CAST(CASE WHEN {s} > 0 AND {e} > 0 THEN (CASE WHEN {s} = {e} THEN 1.0 ELSE 0.5 END) "
            f"ELSE 0.0 END AS DOUBLE)")


PAIRS_CTE = """
pairs AS (
  SELECT conv_id, turn, text AS question, next_text AS answer
  FROM (SELECT conv_id, turn, role, text, lead(role) OVER d AS next_role, lead(text) OVER d AS next_text
        FROM conversations WINDOW d AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'user' AND next_role = 'assistant')
"""

PC_CTE = PAIRS_CTE + """,
pc AS (
  SELECT conv_id, turn,
         '<|im_start|>user' || chr(10) || question || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) AS prompt,
         answer || '<|im_end|>' AS completion
  FROM pairs)
"""
