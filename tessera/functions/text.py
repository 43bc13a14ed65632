"""Column -> Column text helpers. All built from native Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace set of Python's str.isspace / str.strip, written as
# one explicit regex class so Spark (Java regex) and RE2 read it the same way.
WS_CLASS = (r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")

# Chat markup of the ChatML template.
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"

# Full-width to half-width table of the character tokenizer (95 pairs,
# in the order given there). Note the apostrophe U+2019 and the private-use U+E236.
FULL_WIDTH = ("０１２３４５６７８９ＡＢＣＤＥＦＧＨＩＪＫＬＭＮＯＰＱＲＳＴＵＶＷＸＹＺ"
              "ａｂｃｄｅｆｇｈｉｊｋｌｍｎｏｐｑｒｓｔｕｖｗｘｙｚ"
              "！＃＄％＆’（）＊＋，－．／：；＜＝＞？＠［＼］＾＿｀｛｜｝～＂")
HALF_WIDTH = ("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
              "!#$%&'()*+,-./:;<=>?@[\\]^_`{|}~\".")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# The same whitespace set as single characters, for ``btrim`` (no regex).
WS_CHARS = ("".join(chr(c) for c in range(0x09, 0x0E)) + "".join(chr(c) for c in range(0x1C, 0x21))
            + "\x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000")


def ustrip(col) -> Column:
    """Python ``str.strip()``: remove Unicode whitespace at both ends (``btrim``, no regex)."""
    return F.btrim(_c(col), F.lit(WS_CHARS))


def collapse_ws(col) -> Column:
    """T5: every whitespace run becomes one space."""
    return F.regexp_replace(_c(col), f"{WS_CLASS}+", " ")


def normalize_width(col) -> Column:
    """Full-width to half-width by the fixed 95-character table."""
    return F.translate(_c(col), FULL_WIDTH, HALF_WIDTH)


def char_tokens(col) -> Column:
    """T4: T3 then one token per code point."""
    c = normalize_width(col)
    return F.when(F.length(c) == 0, F.array().cast("array<string>")).otherwise(F.split(c, ""))


def ensure_question_mark(col) -> Column:
    """Append a full-width question mark unless the text ends in ? or ？."""
    c = _c(col)
    return F.when(c.endswith("?") | c.endswith("？"), c).otherwise(F.concat(c, F.lit("？")))


def count_keywords(col, words: list[str]) -> Column:
    """Number of keywords that occur as a case-sensitive substring."""
    c = _c(col)
    total = F.lit(0)
    for w in words:
        total = total + F.when(F.instr(c, w) > 0, 1).otherwise(0)
    return total


def extract_reply(col, mode: str = "ppo", prompt=None) -> Column:
    """Text after the last assistant header.

    ``ppo``: remove every end mark, strip; without a marker remove the prompt text and strip.
    ``trl``: marker includes the newline; cut at the first end mark; no strip; without a marker
    the text freed of the two special tokens.
    """
    c = _c(col)
    if mode == "ppo":
        marker = IM_START + "assistant"
        after = F.element_at(F.split(c, _regex_quote(marker)), -1)
        body = ustrip(F.replace(after, F.lit(IM_END), F.lit("")))
        no_marker = ustrip(F.replace(c, _c(prompt), F.lit(""))) if prompt is not None else ustrip(c)
        return F.when(F.instr(c, marker) > 0, body).otherwise(no_marker)
    if mode == "trl":
        marker = IM_START + "assistant\n"
        after = F.element_at(F.split(c, _regex_quote(marker)), -1)
        cut = F.element_at(F.split(after, _regex_quote(IM_END), 2), 1)
        return F.when(F.instr(c, marker) > 0, cut).otherwise(
            F.replace(F.replace(c, F.lit(IM_START), F.lit("")), F.lit(IM_END), F.lit("")))
    raise ValueError(mode)


def _regex_quote(s: str) -> str:
    return "\\Q" + s + "\\E"


def regex_quote(s: str) -> str:
    return _regex_quote(s)
