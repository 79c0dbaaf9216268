"""

usage: python measure.py [sf_dir] [runs]

Seconds are the median of the timed runs after one warm-up.  Rows and shuffle bytes
come from Spark's event log of one further run.  Prints a Markdown table.
"""

from __future__ import annotations

import glob
import json
import statistics
import sys
import tempfile
import time

import check
from millrace.plans import catalog


def _totals(log_dir: str) -> dict[str, tuple[int, int]]:
    """Per job group: (input rows, shuffle bytes written)."""
    group_of_stage: dict[int, str] = {}
    log: list[dict] = []
    totals: dict[str, list[int]] = {}
    for path in sorted(glob.glob(f"{log_dir}/**/events_*", recursive=True)):
        with open(path, encoding="utf-8") as lines:
            log.extend(map(json.loads, lines))
    for event in log:
        if event["Event"] == "SparkListenerJobStart":
            group = event.get("Properties", {}).get("spark.job.description", "")
            for stage in event["Stage IDs"]:
                group_of_stage.setdefault(stage, group)
        elif event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
            group = group_of_stage.get(event["Stage ID"], "")
            metrics = event["Task Metrics"]
            entry = totals.setdefault(group, [0, 0])
            entry[0] += metrics["Input Metrics"]["Records Read"]
            entry[1] += metrics["Shuffle Write Metrics"]["Shuffle Bytes Written"]
    return {k: (v[0], v[1]) for k, v in totals.items()}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    runs = int(sys.argv[2]) if len(sys.argv) > 2 else 5
    log_dir = tempfile.mkdtemp(prefix="measure-")
    spark = check.session(
        **{
            "spark.eventLog.enabled": "true",
            "spark.eventLog.compress": "false",
            "spark.eventLog.dir": f"file://{log_dir}",
        }
    )
    seconds, rows = {}, {}
    for name, plan in catalog.QUERIES.items():
        times = []
        for _ in range(runs + 1):
            begun = time.perf_counter()
            plan(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - begun)
        seconds[name] = statistics.median(times[1:])
        spark.sparkContext.setJobDescription(name)
        rows[name] = plan(spark, sf_dir).count()
        spark.sparkContext.setJobDescription(None)
        print(name, round(seconds[name], 3), file=sys.stderr, flush=True)
    spark.stop()
    totals = _totals(log_dir)
    print("| Query | Seconds | Input rows | Output rows | Shuffle bytes |")
    print("| --- | ---: | ---: | ---: | ---: |")
    for name in seconds:
        read, shuffled = totals.get(name, (0, 0))
        print(f"| `{name}` | {seconds[name]:.2f} | {read:,} | {rows[name]:,} | {shuffled:,} |")


if __name__ == "__main__":
    main()
