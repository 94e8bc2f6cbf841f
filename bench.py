"""Time the headline queries; prints one JSON line.

Each query runs once unmeasured, then RUNS times; the median is reported. Results go to Spark's
no-op sink, so every row is computed and none is moved to the driver.

    BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
    BENCH_RUNS     measured runs per query (default 3)
    BENCH_QUERIES  comma-separated names (default: the headline list; "all" for every query)
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

from tallywork.plans.contract import QUERIES
from tallywork.session import build_session, scratch

HEADLINE = [
    "rating_histogram",
    "popular_items",
    "popular_items_named",
    "item_counts_named",
    "avg_by_key",
    "spend_by_customer",
    "min_max_by_key",
    "word_count_ascii",
    "word_count_unicode",
    "node_degree",
    "most_connected",
    "least_connected_one",
    "least_connected_min",
    "bfs_distances",
    "bfs_hits",
    "sql_range_filter",
    "item_pairs",
    "similarity_jaccard",
    "similarity_cosine",
    "similar_items_jaccard",
    "similar_items_cosine",
    "log_parse",
    "log_status_counts",
    "stream_status_counts",
    "stream_sliding_counts",
    "kfold_assign",
    "holdout_per_user",
    "holdout_limited",
    "similar_items_saved",
    "top_partners",
    "stream_status_table",
    "tree_stump",
    "linear_regression_fit",
    "tree_metrics",
    "als_recommend",
]


def run(spark, name: str, folder: str) -> float:
    with scratch(spark):
        began = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE

    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        # Test tables are small: cut them finely enough to give every core some.
        spark__sql__files__maxPartitionBytes="2m",
        spark__sql__files__openCostInBytes="64k",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in names:
        run(spark, name, folder)
        times[name] = round(statistics.median(run(spark, name, folder) for _ in range(runs)), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()

    scale = re.search(r"sf([0-9.]+)$", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
