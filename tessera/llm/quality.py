"""Quality rules as a bitmask ledger, in built-in functions only.

``ledger`` measures every row once and stores one failure bit per rule beside the measurements.
A policy is a named, versioned set of rules, hence a mask: applying it is one bitwise AND, and an
ablation (what each rule drops alone, what dropping it would let back in) is a count per bit
pattern, at most 2^rules rows, whatever the corpus size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
POSITION_BITS = 30  # of the packed sort keys; Spark strings hold fewer words than that

#: Rules in bit order: name -> failed when this SQL condition on the measurements holds.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 30 * n_words",
    "duplicate_lines": "100 * n_dup_lines > 40 * n_lines",
    "upper_case": "100 * n_upper > 60 * word_chars",
    "word_length": "n_words > 0 and (word_chars < 2 * n_words or word_chars > 20 * n_words)",
}
POLICIES = {
    "base-1": ("few_words", "repeated_words"),
    "full-1": tuple(RULES),
}


def policy_mask(policy: str) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in POLICIES[policy])


def _all_but_last(a: Column) -> Column:
    return F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))


def _rest(a: Column) -> Column:
    return F.slice(a, F.lit(2), F.greatest(F.size(a) - 1, F.lit(0)))


def _positions_of_equals(sorted_keys: Column, equal, position) -> Column:
    """Positions of the sorted entries that equal a neighbour; distinct, in no order."""
    pairs = F.zip_with(_all_but_last(sorted_keys), _rest(sorted_keys),
                       lambda a, b: F.when(equal(a, b), F.array(position(a), position(b))))
    return F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull())))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text measurements) per row. A null text has no words; every count is then 0.

    n_repeat_words counts the words that lie in a 3-word window found twice or more in the text. Window
    hashes are packed with their position and sorted as primitive longs; equal neighbours are candidates,
    which are then compared by the full 64-bit hash. No window leaves its row, so nothing is shuffled.
    """
    low = (1 << POSITION_BITS) - 1
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    rows = rows.select("id", "t", F.array_remove(F.split("t", BLANK + "+"), "").alias("words"),
                       F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD)).alias("lines"))
    rows = rows.select(
        "id", F.size("words").cast("long").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("long"), lambda n, w: n + F.length(w)).alias("word_chars"),
        F.regexp_count("t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.length(F.regexp_replace("t", r"\P{Lu}+", "")).cast("long").alias("n_upper"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    kept = ["id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_upper"]
    n = F.greatest(F.size("h") - 2, F.lit(0))
    pair = F.zip_with(F.slice("h", F.lit(1), n), F.slice("h", F.lit(2), n), lambda a, b: F.xxhash64(a, b))
    rows = rows.select(*kept, F.zip_with(pair, F.slice("h", F.lit(3), n), lambda a, b: F.xxhash64(a, b)).alias("w"))
    rows = rows.select(*kept, "w", F.sort_array(F.transform("w", lambda x, i: x.bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long")))).alias("s"))
    rows = rows.select(*kept, "w", _positions_of_equals(
        F.col("s"), lambda a, b: F.shiftright(a, POSITION_BITS) == F.shiftright(b, POSITION_BITS),
        lambda a: a.bitwiseAND(F.lit(low)).cast("int")).alias("c"))
    rows = rows.select(*kept, F.sort_array(F.transform("c", lambda p: F.struct(F.get("w", p).alias("h"), p.alias("p")))).alias("s"))
    rows = rows.select(*kept, F.sort_array(_positions_of_equals(F.col("s"), lambda a, b: a.h == b.h, lambda a: a.p)).alias("p"))
    steps = F.zip_with(_all_but_last(F.col("p")), _rest(F.col("p")), lambda a, b: F.least(b - a, F.lit(3)))
    covered = F.aggregate(steps, F.lit(0).cast("long"), lambda n, x: n + x)
    repeats = F.when(F.size("p") > 0, covered + 3).otherwise(F.lit(0).cast("long")).alias("n_repeat_words")
    # a generated row: a filter on a measurement would else be pushed below and evaluate every step again
    return rows.select(F.inline(F.array(F.struct(*kept, repeats))))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements plus ``fail_bits`` (long): bit k is set where rule k of ``RULES`` fails."""
    bits = F.lit(0).cast("long")
    for k, condition in enumerate(RULES.values()):
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return measure(docs, id_col, text_col).withColumn("fail_bits", bits)


def passes(policy: str, bits: Column | None = None) -> Column:
    bits = F.col("fail_bits") if bits is None else bits
    return bits.bitwiseAND(F.lit(policy_mask(policy))) == 0


def ablation(rows: DataFrame, policy: str) -> DataFrame:
    """Per rule of the policy: rows that fail it, and rows that only it drops (kept again without it)."""
    mask = policy_mask(policy)
    patterns = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count("*").alias("n"))
    names = list(RULES)
    each = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).alias("bit")) for r in POLICIES[policy]])
    return (patterns.select("bits", "n", F.explode(each).alias("r"))
            .groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("failed"),
                 F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("only_this_rule")))


def quality_filter(docs: DataFrame, policy: str = "full-1") -> DataFrame:
    """Rows of ``docs`` that pass the policy, all columns unchanged.

    The rules are evaluated on the text beside the row, so ids may be null or repeated.
    """
    cols = [F.col(f"r.`{c}`").alias(c) for c in docs.columns]
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("r"), F.col("text").alias("t"))
    judged = ledger(packed, "r", "t").filter(passes(policy))
    return judged.select(F.col("id").alias("r")).select(*cols)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce("text", '') AS t FROM documents),
m AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
w AS (SELECT rid, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM m),
w3 AS (SELECT rid, i, a, lead(a, 1) OVER (PARTITION BY rid ORDER BY i) AS b, lead(a, 2) OVER (PARTITION BY rid ORDER BY i) AS c FROM w),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM w3 WHERE c IS NOT NULL) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY rid),
chars AS (SELECT rid, sum(length(a)) AS n FROM w GROUP BY rid),
f AS (SELECT m.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(chars.n, 0) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             CAST(length(regexp_replace(t, '\P{Lu}+', '', 'g')) AS BIGINT) AS n_upper,
             CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
      FROM m LEFT JOIN covered USING (rid) LEFT JOIN chars USING (rid)),
g AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (100 * n_symbols > 30 * n_words) AND NOT (100 * n_dup_lines > 40 * n_lines)
       AND NOT (100 * n_upper > 60 * word_chars)
       AND NOT (n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words)) AS kept
FROM g
"""
