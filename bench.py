"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8). Each query runs
once to warm up and three times for the median; its result is computed in full and thrown away.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from demand_engine.queries import QUERIES

HEADLINE = (
    "station_hour_demand",
    "station_hour_features",
    "weather_hour_join",
    "standardize_stations",
    "spread_station_join",
    "normalize_trip_names",
    "station_version_range_join",
    "keep_last_per_key",
    "prediction_report",
    "map_columns",
    "csv_mixed_headers",
    "incremental_ingest",
    "weather_cache_upsert",
    "interpolate_hourly",
    "chronological_split",
    "regression_metrics",
    "train_and_score",
)
REPEATS = 3


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(spark, name, sf_dir)
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(REPEATS)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total of the medians of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rpartition("sf")[2],
            }
        )
    )


if __name__ == "__main__":
    main()
