"""De-duplication and set operators.

"First wins" is ``min_by(payload, order)`` grouped by the key: a partial
aggregate, so a key that holds a third of the table is reduced to one row per
map task before the shuffle (a ``row_number`` window would sort it in one task).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import collapse_ws


def first_per_key(df: DataFrame, key: list[str], order: list[str], payload: list[str]) -> DataFrame:
    """Keep, for every key, the row that is smallest in ``order`` (a total order)."""
    ordk = F.struct(*[F.col(c) for c in order])
    body = F.struct(*[F.col(c) for c in order + payload])
    return (df.groupBy(*key).agg(F.min_by(body, ordk).alias("_first"))
            .select(*key, *[F.col("_first")[c].alias(c) for c in order + payload]))


def last_per_key(df: DataFrame, key: list[str], order: list[str], payload: list[str]) -> DataFrame:
    """Keep, for every key, the row that is largest in ``order``."""
    ordk = F.struct(*[F.col(c) for c in order])
    body = F.struct(*[F.col(c) for c in order + payload])
    return (df.groupBy(*key).agg(F.max_by(body, ordk).alias("_last"))
            .select(*key, *[F.col("_last")[c].alias(c) for c in order + payload]))


def text_key(text, n: int | None = None):
    """D1 key: md5 of the text with whitespace runs as one space and lower case; with ``n``
    the first ``n`` characters instead, which also drops texts that differ only after them."""
    flat = F.lower(collapse_ws(text))
    return F.md5(flat) if n is None else F.substring(flat, 1, n)


def dedup_prefix(df: DataFrame, text: str = "text", order: list[str] | None = None, n: int | None = None,
                 payload: list[str] | None = None) -> DataFrame:
    """Drop rows whose key was seen earlier in reading order."""
    order = order or ["doc_id"]
    payload = payload if payload is not None else [text]
    keyed = df.withColumn("dedup_key", text_key(F.col(text), n))
    return first_per_key(keyed, ["dedup_key"], order, payload)


def union_sources(dfs: list[DataFrame], key: list[str]) -> DataFrame:
    """Concatenate listings; rows listed by several patterns appear once."""
    u = reduce(lambda a, b: a.unionByName(b), dfs)
    return u.dropDuplicates(key)


def anti_seen(new: DataFrame, seen: DataFrame, key: list[str]) -> DataFrame:
    """Drop rows whose key is already stored (left anti join)."""
    return new.join(seen.select(*key).distinct(), key, "left_anti")
