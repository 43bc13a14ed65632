"""Plug-in hooks: a user's reward, tokenizer and collate functions over Arrow batches.

The functions are plain Python on lists, as trainers take them; the hooks run them in Arrow batches (pandas UDFs, never row by
row) inside the tasks, with types declared here and a contract that is checked on every batch:

* a batch is at most ``spark.sql.execution.arrow.maxRecordsPerBatch`` rows of any size of table; a function must not count on
  which rows share a batch, nor on their order;
* it returns one result per row, in order, of the declared type (a reward: a finite number or None; ids: integers from 0);
* rows in which a column named in ``needs`` is null are not handed over and have a null result (``needs=()``: all rows
  are, with None where a value is null).

A broken contract ends the job with ``PluginError``. Functions travel by value, so they may be defined anywhere.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need pandas, not this package

Reward = Callable[..., list]


class PluginError(ValueError):
    """A plug-in function broke the contract of its hook."""


def python_value(x):
    """None for nulls of any kind, plain Python values otherwise."""
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    return x.tolist() if hasattr(x, "tolist") else x


def called(fn: Reward, name: str, names: list[str], columns: list[list], needs: list[str], checked: Callable) -> list:
    """Results of one batch: ``checked`` turns each into its declared type or raises."""
    n = len(columns[0])
    needed = [k for k, c in enumerate(names) if c in needs]
    on = [i for i in range(n) if all(columns[k][i] is not None for k in needed)]
    out: list = [None] * n
    if not on:
        return out
    got = fn(**{c: [columns[k][i] for i in on] for k, c in enumerate(names)})
    if not isinstance(got, (list, tuple)) or len(got) != len(on):
        raise PluginError(f"{name}: {len(on)} rows in, {len(got) if hasattr(got, '__len__') else type(got).__name__} out")
    for i, value in zip(on, got):
        out[i] = checked(value)
    return out


def as_reward(name: str) -> Callable:
    def check(value):
        if value is None:
            return None
        if isinstance(value, bool) or not isinstance(value, (int, float)) or not math.isfinite(value):
            raise PluginError(f"{name}: a reward is a finite number or None, not {value!r}")
        return float(value)

    return check


def as_ids(name: str) -> Callable:
    def check(value):
        if value is None:
            return None
        ids = [python_value(x) for x in value]
        if any(isinstance(x, bool) or not isinstance(x, int) or x < 0 for x in ids):
            raise PluginError(f"{name}: ids are integers from 0")
        return ids

    return check


def _hook(fn: Reward, name: str, inputs: dict[str, Column], needs, kind: str, make_check: Callable) -> Column:
    names = list(inputs)
    wanted = names if needs is None else list(needs)
    if unknown := [c for c in wanted if c not in names]:
        raise PluginError(f"{name}: needs {unknown}, which is not an input")

    def run(*series: pd.Series) -> pd.Series:
        columns = [[python_value(x) for x in s] for s in series]
        return pd.Series(called(fn, name, names, columns, wanted, make_check(name)), dtype="object")

    run.__annotations__ = {}
    return F.pandas_udf(run, kind, F.PandasUDFType.SCALAR)(*inputs.values())


def user_reward(fn: Reward, inputs: dict[str, Column], needs: list[str] | tuple | None = None, name: str | None = None) -> Column:
    """``fn(**inputs as lists) -> list of numbers`` as a double column. ``needs``: inputs that must not be null (default: all)."""
    return _hook(fn, name or getattr(fn, "__name__", "reward"), inputs, needs, "double", as_reward)


def user_tokenizer(fn: Callable[[list[str]], list[list[int]]], text: Column, name: str | None = None) -> Column:
    """``fn(texts) -> lists of ids`` as an array<int> column; a null text has null ids."""
    return _hook(lambda texts: fn(texts), name or getattr(fn, "__name__", "tokenizer"), {"texts": text}, None, "array<int>", as_ids)


def with_user_rewards(df: DataFrame, rewards: dict[str, tuple[Reward, dict[str, Column]]], weights: dict[str, float], total: str = "reward") -> DataFrame:
    """Every reward as a column of its name and their weighted sum (R4) as ``total``; a null reward makes the total null."""
    out = df
    for name, (fn, inputs) in rewards.items():
        out = out.withColumn(name, user_reward(fn, inputs, name=name))
    value = F.lit(0.0)
    for name in rewards:
        value = value + F.col(name) * F.lit(float(weights[name]))
    return out.withColumn(total, value)


def user_collate(batches: DataFrame, batch: str, fn: Callable[[list[dict]], list[dict]], schema: str) -> DataFrame:
    """``fn(rows of one batch as dicts) -> rows`` for every value of ``batch`` (W4), rows in the order of their first column.

    A batch is one training batch, so its rows are few by construction; that is what bounds a group here. ``schema`` declares
    the result and must name ``batch``.
    """
    order = batches.columns[0]
    label = getattr(fn, "__name__", "collate")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        rows = [{k: python_value(v) for k, v in r.items()} for r in frame.sort_values(order, kind="stable").to_dict("records")]
        got = fn(rows)
        if not isinstance(got, (list, tuple)) or not all(isinstance(r, dict) for r in got):
            raise PluginError(f"{label}: a collate function returns a list of dicts")
        return pd.DataFrame.from_records(list(got)) if got else pd.DataFrame({c.split()[0]: [] for c in schema.split(", ")})

    return batches.groupBy(batch).applyInPandas(run, schema)
