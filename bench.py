"""Time the headline queries: ``python bench.py`` prints one JSON line.

BENCH_SF_DIR names the folder of test tables, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from worktide.plans.catalog import QUERIES

HEADLINES = (
    "status_counts", "due_top_k", "batch_plan", "start_due_jobs", "recover_expired_jobs", "complete_jobs", "fail_jobs",
    "finish_snapshot", "apply_commands", "command_series", "submit_result", "requeue_jobs", "publishable",
    "publish_results", "envelope", "dashboard", "lifecycle_counters", "duration_histogram", "http_latency",
    "execution_quantiles", "audit", "transition_audit", "attempt_sequence", "job_history", "principals",
    "register_clients", "classify_targets", "clean_headers", "parse_requests", "rate_limit", "apply_handlers",
    "worker_sessions_batch", "expiry_batch", "relay", "dedupe_events", "lifecycle_fold", "metrics_tumbling",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        # Stack traces for every column expression cost more than planning does.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINES
    # One pass warms up the JVM; the better of two timed passes counts.
    timings: dict[str, float] = {}
    for passes in range(3):
        for name in names:
            began = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - began
            if passes:
                timings[name] = min(spent, timings.get(name, spent))
    spark.stop()
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": {name: round(spent, 3) for name, spent in timings.items()}, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
