"""Projections, filters and predicates (P3-P8). Pure projections: no shuffle, and
filters on source columns are pushed into the parquet scan by Catalyst."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_extension(df: DataFrame, col: str, exts: list[str]) -> DataFrame:
    """Keep rows whose ``col`` ends with one of ``exts``, case-insensitively."""
    low = F.lower(F.col(col))
    cond = None
    for e in exts:
        c = low.endswith(e.lower())
        cond = c if cond is None else cond | c
    return df.where(cond)


def select_classes(df: DataFrame, col: str, classes: list) -> DataFrame:
    """Semi filter against a short literal list (``In`` is pushed to the scan)."""
    return df.where(F.col(col).isin(list(classes)))


def quarantine_invalid(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """P5: one pass; ``reason`` = first rule that fails (``rules`` are (name, ok-predicate))."""
    reason = None
    for name, ok in rules:
        reason = F.when(~ok, F.lit(name)) if reason is None else reason.when(~ok, F.lit(name))
    return df.withColumn("reason", reason).withColumn("is_valid", F.col("reason").isNull())


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two outputs of P5 from the one tagged pass."""
    return df.where(F.col("is_valid")), df.where(~F.col("is_valid"))


def coalesce_placeholder(value: Column, default) -> Column:
    """A record that cannot be decoded gets a placeholder value; its label stays."""
    return F.coalesce(value, F.lit(default))


def label_from_path(path: Column, classes: list[str]) -> Column:
    """First path component (after backslash -> slash) that is a class name, else null."""
    parts = F.split(F.translate(path, "\\", "/"), "/")
    cls = F.array(*[F.lit(c) for c in classes])
    return F.try_element_at(F.filter(parts, lambda x: F.array_contains(cls, x)), F.lit(1))


def case_route(rules: list[tuple[Column, str]], default: str) -> Column:
    """First matching rule gives the next step."""
    out = None
    for cond, target in rules:
        out = F.when(cond, F.lit(target)) if out is None else out.when(cond, F.lit(target))
    return out.otherwise(F.lit(default))
