"""Local twin of the driver's correctness gate: each query vs its DuckDB oracle.

Usage: python tools/oracle_check.py [sf_dir] [name-substring ...]
"""
from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from tessera.plans.registry import oracle_sql, queries  # noqa: E402
from tessera.session import get_spark  # noqa: E402
from tessera.sources.tables import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 and sys.argv[1].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in sys.argv[1:] if not a.startswith("/")]
    if os.environ.get("PLAIN_SESSION") == "1":  # a session with Spark's defaults, as a driver may build it
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    else:
        spark = get_spark(os.environ.get("ORACLE_MASTER", "local[8]"), 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, fn in sorted(qs.items()):
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            scols = df.columns
            stypes = [f.dataType.simpleString() for f in df.schema.fields]
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {str(e)[:600]}")
            bad += 1
            continue
        dt = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: {len(srows)} rows ({dt:.1f}s) cols={scols}")
            continue
        try:
            rel = con.execute(sqls[name])
            dcols = [d[0] for d in rel.description]
            dtypes = [str(d[1]) for d in rel.description]
            drows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:600]}")
            bad += 1
            continue
        if sorted(scols) != sorted(dcols):
            print(f"FAIL {name}: columns spark={scols} duck={dcols}")
            bad += 1
            continue
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        import math as _m
        negz = sum(1 for rows in (srows, drows) for r in rows for v in r
                   if isinstance(v, float) and v == 0.0 and _m.copysign(1.0, v) < 0)
        if negz:
            print(f"NOTE {name}: {negz} negative zeros")
        if a != b:
            bad += 1
            from collections import Counter
            ca, cb = Counter(a), Counter(b)
            diff = list((ca - cb).elements())[:2]
            diff2 = list((cb - ca).elements())[:2]
            print(f"FAIL {name}: rows spark={len(a)} duck={len(b)}\n  spark-only {str(diff)[:700]}\n  duck-only {str(diff2)[:700]}")
            continue
        tmap = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "date": "DATE"}
        sd = dict(zip(scols, stypes))
        mism = [(c, sd[c], t) for c, t in zip(dcols, dtypes) if tmap.get(sd[c], sd[c]) != t]
        note = f" TYPES {mism}" if mism else ""
        print(f"OK   {name}: {len(a)} rows ({dt:.1f}s){note}")
    print(f"done, {bad} failing")


if __name__ == "__main__":
    main()
