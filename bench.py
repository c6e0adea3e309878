"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then BENCH_RUNS times (default 3); the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from queries.registry import all_queries  # noqa: E402
from tidemill.session import local_session  # noqa: E402

HEADLINE = [
    "orders_summary_full", "orders_summary_incremental", "channel_order_dedup", "channel_item_latest",
    "channel_sales_as_written", "channel_sales_order_grain", "mapping_orders_summary", "mapping_channel_sales",
    "dq_results_long", "scd2_merge", "incremental_target", "load_replace_day", "load_upsert", "chunk_report",
    "parallel_ranges", "copy_reconcile", "distinct_filter_counts", "json_paths", "stream_incremental",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = sys.argv[1:]
    spark = local_session(cpus, app="bench", shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    found, times = all_queries(), {}
    for name in HEADLINE:
        if only and name not in only:
            continue
        build = found[name][0]
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_queries_total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                      "spark": spark.version, "cpus": cpus, "runs": runs}))


if __name__ == "__main__":
    main()
