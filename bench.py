"""Time the headline queries and print one JSON line.

Every query writes all rows and columns to Spark's ``noop`` sink. The time of a query includes
making its plan and the intermediate tables that it stores. One small query runs first, so that the start of the
session is not charged to the first figure.
"""

from __future__ import annotations

import json
import os
import sys
import time

from paceforge.session import local_session
from paceforge.workloads.queries import QUERIES

HEADLINE = (
    "training_load",
    "weekly_summary",
    "rolling_trends",
    "daily_metrics",
    "run_recovery",
    "workout_recovery",
    "user_lifetime",
    "capped_load",
    "next_day_join",
    "nearest_click",
    "nearest_any_user",
    "missing_photos",
    "incremental_merge",
    "stg_sleeps",
    "stg_runs",
    "conform_workouts",
    "quality_checks",
    "period_counts",
    "period_slots",
    "period_slots_all_users",
    "highlights",
    "polyline_decode",
    "route_positions",
    "user_tracks",
    "export_document",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores)
    QUERIES["latest_events"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    report = {
        "metric": "headline queries, total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cores": cores,
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
