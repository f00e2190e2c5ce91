"""Raw files to standardised trips with station attributes and weather."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demand_engine.functions.times import ntz
from demand_engine.operators.stations import standardize, station_version
from demand_engine.operators.tables import span
from demand_engine.operators.weather import attach_weather
from demand_engine.schemas import VERSION_DATES
from demand_engine.session import workspace
from demand_engine.sources.csv_files import SOURCE_FILE
from demand_engine.sources.dated_trips import NO_DATE, State, current_state, date_text, replace_dates
from demand_engine.sources.files import exists
from demand_engine.sources.landing import unpack
from demand_engine.sources.stations_table import read_stations, update_stations
from demand_engine.sources.trips_table import loaded_files, read_trips, update_trips
from demand_engine.sources.weather_cache import WeatherCache, WeatherSource


def weather_span(trips: DataFrame) -> DataFrame:
    """One row: first day of the trips and the day after the last, the range to fetch weather for."""
    return span(trips).select(
        F.to_date("min_time").alias("first_day"),
        F.date_add(F.to_date("max_time"), 1).alias("last_day"),
    )


def enrich(
    trips: DataFrame,
    stations: DataFrame,
    weather: DataFrame,
    dates: Mapping[int, datetime] = VERSION_DATES,
) -> DataFrame:
    """Standardised trips with the weather of their hour. Small dimensions are broadcast, so trips
    pass from scan to write without a shuffle."""
    return standardize(
        trips, stations, lambda column: station_version(column, dates)
    ).transform(attach_weather, weather)


def _weather_hashes(weather: DataFrame) -> dict[str, int]:
    hashed = weather.groupBy(date_text(F.to_date("time")).alias("date")).agg(F.bit_xor(F.xxhash64(*weather.columns)).alias("hash"))
    return {r["date"]: r["hash"] for r in hashed.collect()}


def _stations_hash(stations: DataFrame, dates: Mapping[int, datetime]) -> str:
    columns = sorted(stations.columns)
    row = stations.agg(F.bit_xor(F.xxhash64(*columns)).alias("hash"), F.count(F.lit(1)).alias("n")).first()
    return f"{row['hash']}:{row['n']}:{[(version, str(day)) for version, day in dates.items()]}"


def touched_dates(trips: DataFrame, state: State, files: dict[str, int | None], weather: dict[str, int]) -> set[str]:
    """Dates whose rows may have changed since a state: those that changed, new or dropped files had or have
    trips on, and those with other weather."""
    changed = [n for n, time in files.items() if n not in state.files or state.files[n]["mtime"] != time]
    gone = [n for n in state.files if n not in files]
    touched = {d for n in [*changed, *gone] for d in state.files.get(n, {"dates": []})["dates"]}
    if changed:
        own = trips.where(F.col(SOURCE_FILE).isin(changed)).select(date_text(F.to_date("started_at")).alias("date"))
        touched |= {r["date"] for r in own.distinct().collect()}
    return touched | {d for d in state.dates if state.weather.get(d) != weather.get(d)}


def on_dates(trips: DataFrame, dates: Collection[str]) -> DataFrame:
    """The trips that start on some dates; bounds on the raw time reach the scan."""
    days = sorted(date.fromisoformat(d) for d in dates if d != NO_DATE)
    started = F.col("started_at")
    wanted = F.lit(False)
    if days:
        low, high = datetime.combine(days[0], time.min), datetime.combine(days[-1] + timedelta(days=1), time.min)
        wanted = (started >= ntz(low)) & (started < ntz(high)) & F.to_date(started).isin(days)
    return trips.where(wanted | started.isNull() if NO_DATE in dates else wanted)


def prepare(
    spark: SparkSession,
    source_dir: str,
    work_dir: str,
    weather_source: WeatherSource,
    station_files: Mapping[int, str],
    dates: Mapping[int, datetime] = VERSION_DATES,
) -> str:
    """The whole job; returns the path of the standardised trips (`dated_trips.read_dated` reads them).
    `station_files` names the station list of each version (`stations_table.read_snapshots`).

    Safe to repeat: only files that are new or changed are read, and only the dates that they, or other
    weather, touch are made again. Other station lists make all of them again.
    """
    with workspace(spark, "prepare"):
        raw, stations_path = f"{work_dir}/raw", f"{work_dir}/stations"
        unpack(spark, source_dir, raw)
        folders = [f for f in (raw, source_dir) if exists(spark, f)]
        update_trips(spark, folders, f"{work_dir}/trips")
        update_stations(spark, folders, stations_path, station_files, dates)
        trips = read_trips(spark, f"{work_dir}/trips")
        days = weather_span(trips).first()
        cache = WeatherCache(spark, f"{work_dir}/weather", weather_source)
        weather = cache.weather(
            datetime.combine(days["first_day"], time.min), datetime.combine(days["last_day"], time.min)
        )
        return refresh(
            trips, read_stations(spark, stations_path), weather, dates,
            f"{work_dir}/trips_standardized", loaded_files(spark, f"{work_dir}/trips"),
        )


def refresh(
    trips: DataFrame,
    stations: DataFrame,
    weather: DataFrame,
    dates: Mapping[int, datetime],
    table: str,
    files: dict[str, int | None],
) -> str:
    """Bring the standardised trips in line with what they are made from, date by date."""
    state = current_state(trips.sparkSession, table)
    hashes, lists = _weather_hashes(weather), _stations_hash(stations, dates)
    touched = None
    if state is not None and state.stations == lists:
        touched = touched_dates(trips, state, files, hashes)
        if not touched and state.files.keys() == files.keys():
            return table
    rows = trips if touched is None else on_dates(trips, touched)
    replace_dates(enrich(rows, stations, weather, dates), table, touched, files, hashes, lists)
    return table


def whole_days(first: datetime, last: datetime) -> tuple[datetime, datetime]:
    """Closed range of whole days, to the last full second."""
    return (
        datetime.combine(first.date(), time.min),
        datetime.combine(last.date(), time.min) + timedelta(days=1) - timedelta(seconds=1),
    )
