"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   folder with the Parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS     local threads (default 8)
BENCH_QUERIES  comma-separated names (default: the headline list)
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from stayflow.queries import QUERIES

HEADLINE = [
    "unit_stays",
    "mark_edges",
    "gap_rows",
    "churn_counts",
    "points_in_intervals",
    "trackers",
    "next_matching_unit",
    "bounce_back_hours",
    "split_on_change",
    "close_open_intervals",
    "drop_orphans",
    "repair_account_trackers",
    "dated_dimension",
    "classify_by_dated_record",
    "movement_detail",
    "only_code",
    "either_key",
    "recent_activity",
    "linked_by_merge",
    "cohort_in_steps",
    "upsert_by_key_moves",
    "clean_grid",
    "unit_activity",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else [n for n in HEADLINE if n in QUERIES]
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("stayflow-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/events.parquet").groupBy("user_id").count().write.format(
        "noop"
    ).mode("overwrite").save()  # start the workers before the clock
    times: dict[str, float] = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
