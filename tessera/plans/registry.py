"""Registry of named queries: a Spark callable plus its DuckDB oracle SQL.

A query callable takes ``(spark, sf_dir)`` and returns a DataFrame whose columns are
scalars (arrays are rendered with ``array_join`` on both sides) so the driver's
value hash compares like with like. ``sql=None`` marks a rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql.strip()
        return fn
    return deco


def _load_all() -> None:
    # Importing the modules fills the registry.
    from tessera.plans import (  # noqa: F401
        q_chat, q_rewards, q_text, q_tokens, q_eval, q_vectors, q_trace, q_graph, q_sources, q_stream,
    )


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from tessera.functions.numeric import nudge_sql
    _load_all()
    return {k: nudge_sql(v) for k, v in _SQL.items()}
