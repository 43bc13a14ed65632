"""Every registered query against its DuckDB oracle on the smallest fixture (the driver
runs the same comparison at sf0.01), plus the smoke entry."""

import math
import os
from collections import Counter

import duckdb
import pytest

SF = os.environ.get("TESSERA_TEST_SF", "/root/testdata/sf0.001")


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    from tessera.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _names():
    from tessera.plans import registry
    return sorted(registry.queries())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as e
    df = e.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    sql = e.oracle_sql().get(name)
    if sql is None:
        assert len(df.columns) > 0
        return
    rel = duck.execute(sql)
    dcols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _bag(df.columns, srows) == _bag(dcols, rel.fetchall())


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == ["conv_id", "turn", "reward", "advantage", "completion"]
    assert df.count() >= 0
