"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (no driver collect):
one warm-up, then the median of ``$BENCH_REPEATS`` (default 3) timed runs.
Prints one JSON line. ``--all`` times every registered query instead of the
headline set; ``--only name,name`` picks queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans.registry import queries  # noqa: E402
from tessera.session import get_spark  # noqa: E402
from tessera.sources.files import scratch_dir  # noqa: E402

HEADLINE = [
    "grpo_best_completion",   # C3 -> R1..R4 -> W5 -> best per dialog
    "c4_to_multiturn_samples",
    "d2_dedup_questions",
    "t1_md_sections",
    "d1_dedup_prefix",
    "t4_char_tokens",
    "j2_vocab_encode",
    "a7_pad_batch",
    "g10_masked_mean_loss",
    "w1_stratified_split",
    "g4_classification_report",
    "j8_knn_join",
    "v2_retry_budget",
    "w10_agent_transitions",
    "d3_dedup_graph",
    "m3_semantic_recall",
    "j7_graph_typed_match",
]


#: Queries over ``documents`` alone. The table is one file with one row group at sf0.1, which a scan can't divide (at scale it has
ON_SEVERAL_FILES = {"t1_md_sections", "t4_char_tokens", "d1_dedup_prefix"}


def several_files(spark, sf: str, n: int) -> str:
    root = scratch_dir(spark, "bench")
    spark.read.parquet(f"{sf.rstrip('/')}/documents.parquet").repartition(n, "doc_id").write.parquet(f"{root}/documents.parquet")
    return root


def run_once(spark, fn, sf) -> float:
    spark.catalog.clearCache()
    t0 = time.perf_counter()
    fn(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = get_spark(f"local[{cpus}]", cpus, app_name="tessera-bench",
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                             "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024)})
    qs = queries()
    names = HEADLINE
    if "--all" in sys.argv:
        names = sorted(qs)
    if "--only" in sys.argv:
        names = sys.argv[sys.argv.index("--only") + 1].split(",")
    times = {}
    split = several_files(spark, sf, cpus) if ON_SEVERAL_FILES & set(names) else sf
    for name in names:
        fn, at = qs[name], split if name in ON_SEVERAL_FILES else sf
        run_once(spark, fn, at)  # warm-up
        times[name] = round(statistics.median(run_once(spark, fn, at) for _ in range(repeats)), 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    sf_name = os.path.basename(sf.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": total, "unit": "sec",
                      "queries": times, "sf": sf_name, "cpus": cpus, "repeats": repeats}))


if __name__ == "__main__":
    main()
