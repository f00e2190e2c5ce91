"""Command line: prepare, train, report."""

from __future__ import annotations

import argparse
from datetime import datetime, time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demand_engine.functions.times import previous_month
from demand_engine.operators.boosting import load_boosted
from demand_engine.operators.modeling import TEST_MONTHS, TRIALS, scorer
from demand_engine.operators.places import interpolated_source
from demand_engine.operators.tables import between
from demand_engine.plans.prepare import prepare, whole_days
from demand_engine.plans.report import write_report
from demand_engine.plans.train import train
from demand_engine.sources.stations_table import exact_files
from demand_engine.session import engine_session
from demand_engine.sources.datasets import load_table
from demand_engine.sources.dated_trips import read_dated


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="demand_engine", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("prepare", help="raw files to standardised trips")
    job.add_argument("source_dir")
    job.add_argument("work_dir")
    job.add_argument("observations", help="Parquet table of hourly weather observations")
    job.add_argument("--observing-stations", help="Parquet table (station_id, lat, lng); with it, observations have a station_id and the city's weather is estimated from them")
    job.add_argument("--station-files", nargs="+", metavar="NAME", required=True, help="exact names of the station lists, by version")

    job = jobs.add_parser("train", help="fit and log a model")
    job.add_argument("work_dir")
    job.add_argument("--trials", type=int, default=TRIALS)
    job.add_argument("--test-months", type=int, default=TEST_MONTHS)

    job = jobs.add_parser("report", help="write actual against predicted demand, its hours and its map")
    job.add_argument("work_dir")
    for day in ("first_day", "last_day"):
        job.add_argument(day, type=datetime.fromisoformat, nargs="?", help="default: the previous month")
    return parser.parse_args()


def main() -> None:
    args = _arguments()
    spark = engine_session()
    if args.job == "prepare":
        observed = load_table(spark, args.observations)
        lists = exact_files(args.station_files)

        def asked(start: datetime, end: datetime) -> DataFrame:
            return between(observed, "time", start, end)

        source = interpolated_source(observed, load_table(spark, args.observing_stations)) if args.observing_stations else asked
        print(prepare(spark, args.source_dir, args.work_dir, source, lists))
        return
    trips = read_dated(spark, f"{args.work_dir}/trips_standardized")
    model = f"{args.work_dir}/model"
    if args.job == "train":
        print(train(trips, model, f"{args.work_dir}/runs", None, args.trials, args.test_months))
        return
    if args.last_day is None:
        month = previous_month(F.current_date())
        days = spark.range(1).select(*(c.alias(name) for name, c in month.items())).first()
        first, last = (datetime.combine(d, time.min) for d in days)
        days = whole_days(args.first_day or first, last)
    else:
        days = whole_days(args.first_day, args.last_day)
    for path in write_report(spark, trips, scorer(load_boosted(spark, model)), *days, args.work_dir):
        print(path)


if __name__ == "__main__":
    main()
