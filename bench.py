"""Time the headline queries, each from the base tables; prints one JSON line.

BENCH_SF_DIR   table folder (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names (default: the list below)
BENCH_WARMUP   1 runs every query once before timing (default 0: cold session)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

import query_registry

HEADLINE = (
    "clean_transactions",
    "cleaning_stats",
    "dq_report",
    "features_all_snapshots",
    "temporal_consistency",
    "churn_labels",
    "churn_label_stats",
    "clv_targets",
    "temporal_split",
    "roc_auc_rank",
    "threshold_search",
    "decile_analysis",
    "segment_profiles",
    "greedy_allocation_tight",
    "budget_sensitivity",
    "customer_action_list",
    "business_summary",
    "kmeans_k_search",
    "churn_gbt_scores",
    "clv_quantile_bands",
)


def timed(spark: SparkSession, name: str, folder: str) -> float:
    query_registry.forget()  # nothing staged by an earlier query is reused
    begin = time.perf_counter()
    result = query_registry.QUERIES[name](query_registry.Inputs(spark, folder))
    result.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split(",")
    names = [n for n in names if n] or list(HEADLINE)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemark-"))  # one machine
        # Small tables: joins are shuffled, so that all cores work on them.
        .config("spark.sql.autoBroadcastJoinThreshold", "1m")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("BENCH_WARMUP") == "1":
        for name in names:
            timed(spark, name, folder)
    seconds = {}
    for name in names:
        seconds[name] = round(timed(spark, name, folder), 3)
        print(f"{name}: {seconds[name]}s", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline queries, each from base tables",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
