"""Time headline queries on local Spark and print one JSON line.

Reads ``BENCH_SF_DIR`` (default /root/testdata/sf0.1) with ``BENCH_CPUS`` cores (default 8). Every query runs once to warm up and
twice for time, of which the better counts; results are produced in full and discarded. ``loop_sec`` is the time of a fixed loop on one
core and says how fast the machine was meanwhile: times of different runs compare by their ratio to it.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from harness.queries import QUERIES  # noqa: E402

HEADLINE = (
    "session_funnel",
    "funnel_summary",
    "session_event_density",
    "cohort_retention_summary",
    "weighted_retention_curve",
    "activity_retention",
    "category_quadrants",
    "brand_revenue",
    "dim_product",
    "star_join",
    "peak_view_spike",
    "executive_kpis",
    "price_percentiles",
    "ticket_daily_kpis",
    "ticket_queue_performance",
    "ticket_data_quality",
)


def loop_seconds() -> float:
    """The best of five runs of a fixed loop."""
    runs = []
    for _ in range(5):
        began = time.perf_counter()
        sum(k * k % 7 for k in range(2_000_000))
        runs.append(time.perf_counter() - began)
    return round(min(runs), 4)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    times, loops = {}, [loop_seconds()]
    for name in wanted:
        query = QUERIES[name]
        runs = []
        for _ in range(3):
            began = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - began)
        times[name] = round(min(runs[1:]), 3)
    loops.append(loop_seconds())
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "loop_sec": max(loops),
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
