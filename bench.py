"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  folder of the driver tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_QUERIES comma-separated names, or "all" (default: the headline list)
"""

from __future__ import annotations

import json
import os
import sys
import time

from checks import registry
from gaugeworks import local_session

HEADLINE = [
    "wait_deltas",
    "io_latency_deltas",
    "cpu_hour_heatmap",
    "top_queries",
    "table_storage_latest",
    "table_growth",
    "table_access_daily",
    "table_access_trend",
    "index_opportunities",
    "tuning_candidates",
    "health_summary",
    "workload_by_category",
    "top_logins",
    "active_requests",
    "live_blocking",
    "concurrency_now",
    "ingest_cpu",
    "ingest_query_perf",
    "ingest_workload",
    "ingest_sessions",
    "ingest_storage",
    "ingest_index_ops",
    "ingest_table_access",
    "ingest_health",
    "ingest_deadlocks",
    "upsert",
    "streaming_counter_deltas",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    queries = registry.callables()
    names = list(queries) if chosen == "all" else chosen.split(",") if chosen else HEADLINE

    spark = local_session(cpus, app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    queries["cpu_timeline"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start the JVM paths

    cold, warm = {}, {}
    for name in names:
        for times in (cold, warm):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: cold {cold[name]} warm {warm[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_warm_total",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
