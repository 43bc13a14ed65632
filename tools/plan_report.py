"""Summarise the physical plan of every registered query (written to PLANS.md).

For each query: shuffles (Exchange), broadcasts, join and aggregate strategies,
windows, Python nodes, and whether filters reached a scan. The plan is the one
AQE starts from (before run-time re-planning).
Usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""
from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from tessera.plans.registry import queries  # noqa: E402
from tessera.session import get_spark  # noqa: E402

NODES = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange RoundRobinPartitioning",
         "Exchange SinglePartition", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin",
         "BroadcastNestedLoopJoin", "CartesianProduct", "ShuffledHashJoin", "HashAggregate", "SortAggregate",
         "ObjectHashAggregate", "Window", "TakeOrderedAndProject", "InMemoryTableScan",
         "FlatMapCoGroupsInPandas", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"]
SHORT = {"Exchange hashpartitioning": "hash-x", "Exchange rangepartitioning": "range-x",
         "Exchange RoundRobinPartitioning": "rr-x", "Exchange SinglePartition": "single-x",
         "BroadcastExchange": "bcast", "SortMergeJoin": "SMJ", "BroadcastHashJoin": "BHJ",
         "BroadcastNestedLoopJoin": "BNLJ", "CartesianProduct": "cartesian", "ShuffledHashJoin": "SHJ",
         "HashAggregate": "hash-agg", "SortAggregate": "sort-agg", "ObjectHashAggregate": "obj-agg",
         "Window": "window", "TakeOrderedAndProject": "top-n", "InMemoryTableScan": "cached-scan",
         "FlatMapCoGroupsInPandas": "pandas-cogroup", "ArrowEvalPython": "pandas-udf",
         "BatchEvalPython": "python-udf", "MapInPandas": "mapInPandas"}


def _outer_plan(plan: str) -> tuple[str, int]:
    """Drop the bodies of cached relations and subqueries (printed again at every reference)
    and count the distinct scalar subqueries."""
    keep, skip_at = [], None
    subs = set(re.findall(r"Subquery subquery#(\d+)", plan)) | set(re.findall(r"ReusedSubquery Subquery subquery#(\d+)", plan))
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :|+-"))
        if skip_at is not None:
            if depth > skip_at:
                continue
            skip_at = None
        keep.append(line)
        if "InMemoryRelation" in line or re.search(r"\bSubquery subquery#", line):
            skip_at = depth
    return "\n".join(keep), len(subs)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", 8)
    print("# Physical plans\n")
    print(f"Generated by `tools/plan_report.py` on `{sf}`: node counts in the plan AQE starts from "
          "(x = exchange/shuffle, bcast = broadcast exchange; a `hash-agg`/`sort-agg` pair is a partial "
          "plus a final aggregate). Streaming and source/sink keys show the read-back plan only.\n")
    print("| query | nodes | pushed filters |")
    print("|---|---|---|")
    for name, fn in sorted(queries().items()):
        try:
            plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        except Exception as e:  # noqa: BLE001
            print(f"| {name} | error: {str(e)[:80]} | |")
            continue
        plan, n_sub = _outer_plan(plan)
        counts = []
        for n in NODES:
            c = len(re.findall(re.escape(n), plan))
            if n == "HashAggregate":
                c -= len(re.findall("ObjectHashAggregate", plan))
            if n == "Exchange hashpartitioning":
                c = len(re.findall(r"Exchange hashpartitioning", plan))
            if c:
                counts.append(f"{SHORT[n]}×{c}")
        pushed = len(re.findall(r"PushedFilters: \[[^\]]+\]", plan))
        if n_sub:
            counts.append(f"scalar-subquery×{n_sub}")
        print(f"| `{name}` | {', '.join(counts) or 'scan/project only'} | {pushed} scan(s) |")


if __name__ == "__main__":
    main()
