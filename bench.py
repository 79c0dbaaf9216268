"""Time the headline queries and print one JSON line.

environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query after one warm-up, default 3), BENCH_QUERIES
(comma-separated names, default the list below; ``all`` for every query).
"""

from __future__ import annotations

import json
import os
import statistics
import time

import check
from millrace.plans import catalog

HEADLINE = [
    "envelope",
    "template_render",
    "script_filter",
    "script_fanout",
    "normalize_keys",
    "to_record",
    "iterate_key",
    "batch_to_json",
    "state_latest",
    "state_history",
    "dedup_window",
    "retain_per_subject",
    "retain_bytes",
    "publish_ack",
    "replay_after_cursor",
    "request_ingest",
    "request_render",
    "schedule_cron",
    "hive_partition_layout",
    "read_csv_typed",
    "flow_land_events",
    "flow_orders_fanout",
    "stream_land",
]


def run(spark, name: str, sf_dir: str) -> float:
    begun = time.perf_counter()
    catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begun


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(catalog.QUERIES) if wanted == "all" else [n for n in wanted.split(",") if n] or HEADLINE
    spark = check.session(os.environ.get("BENCH_CPUS", "8"))
    seconds = {}
    # The session is warm before anything is timed: queries that run first would
    # otherwise pay for loading classes and compiling.
    for name in names:
        run(spark, name, sf_dir)
    for name in names:
        run(spark, name, sf_dir)
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(runs)), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of median seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
