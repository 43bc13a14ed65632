"""Text-to-rows operators.

All splitting is done with Java regex inside the JVM; one input row fans out to
its pieces in the same task (no shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import WS_CLASS, ustrip

# Heading of level 2 or 3 at a line start: ``^(#{2,3})\s+(.+)$`` with Python's
# line semantics ((?d): only \n ends a line) and Python's whitespace set.
HEADING = f"#{{2,3}}{WS_CLASS}+.+"
HEADING_SPLIT = f"(?dm)(?=^{HEADING}$)"
HEADING_AT_START = f"(?d)^{HEADING}"
BLANK_LINE_SPLIT = f"\\n{WS_CLASS}*\\n"


def md_sections(df: DataFrame, text: str = "text", id_col: str = "doc_id", min_len: int = 100) -> DataFrame:
    """A block runs from a level-2/3 heading to the next one (heading line kept),
    stripped, kept when at least ``min_len`` characters. Text before the first
    heading is dropped; level-1 and level-4+ headings do not cut."""
    parts = df.select(id_col, F.posexplode(F.split(F.col(text), HEADING_SPLIT)).alias("block", "_raw"))
    return (parts.where((F.col("block") > 0) | F.col("_raw").rlike(HEADING_AT_START))
            .select(id_col, "block", ustrip(F.col("_raw")).alias("section"))
            .where(F.length("section") >= min_len))


def md_paragraphs(df: DataFrame, text: str = "text", id_col: str = "doc_id", min_len: int = 100) -> DataFrame:
    """Split on blank lines, strip, keep at least ``min_len`` characters."""
    parts = df.select(id_col, F.posexplode(F.split(F.col(text), BLANK_LINE_SPLIT)).alias("para", "_raw"))
    return (parts.select(id_col, "para", ustrip(F.col("_raw")).alias("section"))
            .where(F.length("section") >= min_len))


def sections_or_paragraphs(df: DataFrame, text: str = "text", id_col: str = "doc_id",
                           min_len: int = 100) -> DataFrame:
    """T1 when the document has a level-2/3 heading, else T2 (decided per document)."""
    has = F.col(text).rlike(f"(?dm)^{HEADING}$")
    a = md_sections(df.where(has), text, id_col, min_len).withColumnRenamed("block", "part")
    b = md_paragraphs(df.where(~has), text, id_col, min_len).withColumnRenamed("para", "part")
    return a.unionByName(b)


def extract_json_pair(df: DataFrame, text: str, fields=("instruction", "output")) -> DataFrame:
    """First ``{`` to last ``}``, parse, strip both fields; a ``reason`` says why a row failed.

    Failing rows are kept with a reason so P5 can report them (one pass, no re-read).
    """
    raw = F.regexp_extract(F.col(text), r"(?s)(\{.*\})", 1)
    # strict JSON, one object and nothing after it: inside brackets it must be an array of one
    out = df.withColumn("_raw", raw).withColumn("_v", F.try_parse_json(F.concat(F.lit("["), raw, F.lit("]"))))
    one = F.col("_v").isNotNull() & F.try_variant_get("_v", "$[1]", "variant").isNull()
    out = out.withColumn("_ok", one)
    empty = wrong = F.lit(False)
    for f in fields:
        value = F.try_variant_get("_v", f"$[0].{f}", "variant")
        kind = F.schema_of_variant(value)
        out = out.withColumn(f, F.when(F.col("_ok") & (kind == "STRING"), ustrip(F.try_variant_get("_v", f"$[0].{f}", "string"))))
        out = out.withColumn(f"_t_{f}", F.coalesce(kind.isin("STRING", "VOID"), F.lit(True)))
        wrong = wrong | ~F.col(f"_t_{f}")
        empty = empty | F.col(f).isNull() | (F.length(F.col(f)) == 0)
    reason = (F.when(F.length("_raw") == 0, F.lit("no_json"))
              .when(~F.col("_ok"), F.lit("bad_json"))
              .when(wrong, F.lit("not_text"))
              .when(empty, F.lit("empty_field")))
    return out.withColumn("reason", reason).drop("_raw", "_v", "_ok", *[f"_t_{f}" for f in fields])


def validate_struct(df: DataFrame, text: str, schema: str, ranges: dict[str, tuple] | None = None,
                    enums: dict[str, list] | None = None, max_items: dict[str, int] | None = None) -> DataFrame:
    """Parse model output against a typed schema; check value ranges, allowed values and list lengths.

    Adds the parsed fields, ``is_valid`` and ``reason`` (first failing check: ``field:missing``,
    ``field:range``, ``field:enum`` or ``field:length``)."""
    ranges, enums, max_items = ranges or {}, enums or {}, max_items or {}
    out = df.withColumn("_p", F.from_json(F.col(text), schema, {"mode": "PERMISSIVE"}))
    checks = []
    for field in dict.fromkeys([*ranges, *enums, *max_items]):
        out = out.withColumn(field, F.col("_p")[field])
        checks.append((F.col(field).isNull(), f"{field}:missing"))
        if field in ranges:
            lo, hi = ranges[field]
            checks.append(((F.col(field) < F.lit(lo)) | (F.col(field) > F.lit(hi)), f"{field}:range"))
        if field in enums:
            checks.append((~F.col(field).isin(*enums[field]), f"{field}:enum"))
        if field in max_items:
            checks.append((F.size(field) > max_items[field], f"{field}:length"))
    reason = F.coalesce(*[F.when(bad, F.lit(name)) for bad, name in checks], F.lit(None).cast("string"))
    return out.withColumn("reason", reason).withColumn("is_valid", F.col("reason").isNull()).drop("_p")


# Fixed value: tool call ``name("query")`` or ``name('query')``; letters of any script.
TOOL_CALL = r"(?U)(\w+)\((?:\"|')(.*?)(?:\"|')\)"


def parse_tool_call(df: DataFrame, text: str, default_tool: str = "web_search") -> DataFrame:
    """Tool name and query from a plan step; no match -> default tool, whole string."""
    hit = F.col(text).rlike(TOOL_CALL)
    return (df.withColumn("tool", F.when(hit, F.regexp_extract(F.col(text), TOOL_CALL, 1)).otherwise(F.lit(default_tool)))
            .withColumn("query", F.when(hit, F.regexp_extract(F.col(text), TOOL_CALL, 2)).otherwise(F.col(text))))


def keyword_split(df: DataFrame, text: str, id_col: str) -> DataFrame:
    """Query text to keywords on whitespace runs, one row per keyword."""
    words = F.filter(F.split(F.col(text), f"{WS_CLASS}+"), lambda x: x != "")
    return df.select(id_col, F.posexplode(words).alias("pos", "keyword"))
