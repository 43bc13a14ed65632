"""Rounding used for reported numbers.

Averages of two-decimal data often land exactly on a rounding boundary (for
example 0.5150875), and two engines that add the same doubles in a different
order then round to different sides. A nudge of 1e-9, far below the reported
precision, moves such exact ties to one side for every engine.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

NUDGE = 1e-9


def r6(c, digits: int = 6) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + F.lit(NUDGE), digits)


_ROUND = re.compile(r"round\(", re.IGNORECASE)


def _call_end(sql: str, start: int) -> tuple[int, int | None]:
    """Index just past the ``)`` closing the call whose arguments start at ``start``, and
    the position of its top-level comma (quoted text is skipped)."""
    depth, j, comma, in_str = 1, start, None, False
    while depth:
        ch = sql[j]
        if ch == "'":
            in_str = not in_str
        elif not in_str:
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = j
        j += 1
    return j, comma


def nudge_sql(sql: str) -> str:
    """Rewrite every ``round(expr, d)`` in SQL text to ``round((expr) + 1e-9, d)``;
    text inside quotes is left alone."""
    out, i, in_str = [], 0, False
    while i < len(sql):
        ch = sql[i]
        if ch == "'":
            in_str = not in_str
        elif (not in_str and _ROUND.match(sql, i)
              and (i == 0 or not (sql[i - 1].isalnum() or sql[i - 1] == "_"))):
            start = i + len("round(")
            end, comma = _call_end(sql, start)
            if comma is None:
                out.append(sql[i:end])
            else:
                expr, digits = sql[start:comma], sql[comma + 1:end - 1]
                out.append(f"round(({nudge_sql(expr)}) + {NUDGE}, {digits.strip()})")
            i = end
            continue
        out.append(ch)
        i += 1
    return "".join(out)
