"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is planned and run to completion into Spark's ``noop`` sink (the
whole plan executes, nothing is collected); the time is the median of
$BENCH_REPEATS runs after one warm-up.  Shuffle bytes written per run come from
Spark's event log, written to a fresh scratch folder.  Prints one JSON line.
"""

from __future__ import annotations

import glob
import json
import os
import re
import statistics
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "lint_report", "group_status", "effective_parameters", "delete_preflight", "connection_validate",
    "provenance_search_component", "provenance_search_inverse", "provenance_event_content",
    "bulletin_feed_group", "queue_listing", "backpressure_check", "flowfile_expiry",
    "component_roles", "error_paths", "pipeline_spec_expand", "versioned_apply", "state_apply",
    "config_update", "relationship_route", "canvas_processors", "provenance_stream",
    "versioned_table", "pipeline_tree", "lint_documents", "flow_counts",
]


def shuffle_bytes_by_run(log_dir: str, runs: list) -> dict:
    """Shuffle bytes written per key, summed over the event log's tasks.

    A job belongs to the timed run in which it was submitted; job groups would
    miss streams, which run their jobs under a group of their own.
    """
    stage_key, totals = {}, defaultdict(int)
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)):
        if os.path.isdir(path) or os.path.basename(path).startswith((".", "appstatus")):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    at = ev.get("Submission Time", 0) / 1000
                    key = next((k for k, begin, end in runs if begin <= at <= end), None)
                    for sid in ev.get("Stage IDs", []):
                        stage_key.setdefault(sid, key)
                elif kind == "SparkListenerTaskEnd":
                    key = stage_key.get(ev.get("Stage ID"))
                    metrics = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    if key:
                        totals[key] += int(metrics.get("Shuffle Bytes Written", 0))
    return totals


def main() -> None:
    from flowlake.plans.catalog import QUERIES
    from flowlake.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    keys = only or HEADLINE
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None

    log_dir = tempfile.mkdtemp(prefix="flowlake-bench-events-")
    spark = build_session(app_name="flowlake-bench",
                          extra_conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                      "spark.eventLog.compress": "false"})
    runs = []

    def run(key, timed):
        begin, t0 = time.time(), time.perf_counter()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - t0
        if timed:
            runs.append((key, begin, time.time()))
        return took

    times = {}
    for key in keys:
        run(key, False)
        times[key] = round(statistics.median(run(key, True) for _ in range(repeats)), 3)
        print(f"# {key}: {times[key]}s", file=sys.stderr, flush=True)
    spark.stop()

    shuffled = shuffle_bytes_by_run(log_dir, runs)
    shuffle = {k: shuffled.get(k, 0) // repeats for k in keys}
    print(json.dumps({"metric": "sum_of_median_query_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf,
                      "shuffle_bytes_per_run": shuffle,
                      "cpus": int(os.environ.get("BENCH_CPUS", "8")), "repeats": repeats}))


if __name__ == "__main__":
    main()
