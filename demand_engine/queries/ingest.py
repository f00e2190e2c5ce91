"""Files in and out. Each query writes the given events as files, then reads them back."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demand_engine.functions.times import parse_time
from demand_engine.operators.quality import unreadable
from demand_engine.operators.tables import between
from demand_engine.plans.prepare import whole_days
from demand_engine.queries.registry import query
from demand_engine.queries.views import VERSION_DATES, sql, stations, table, trips
from demand_engine.session import scratch_path
from demand_engine.sources.csv_files import SOURCE_FILE, read_trip_csv
from demand_engine.sources.datasets import load_table, save_table, save_trips
from demand_engine.sources.files import created, exists, list_objects, qualified, rename, trip_files
from demand_engine.sources.landing import unpack
from demand_engine.sources.stations_table import read_stations, update_stations
from demand_engine.sources.trips_table import (
    classify,
    load_manifest,
    needs_rebuild,
    read_trips,
    save_manifest,
    update_trips,
)

_OLD_TYPES = ("click", "view", "purchase")


def _when(pattern: str) -> Column:
    return F.date_format("ts", pattern)


def _old_files(events: DataFrame) -> DataFrame:
    """The old header; only clicks have a rider type, purchases have an unreadable time, and every
    fifth station name has a line break inside quotes."""
    kind = F.col("event_type")
    space = F.when(F.col("event_id") % 5 == 0, "\n").otherwise(" ")
    return events.select(
        (F.col("event_id") % 90 * 60).alias("tripduration"),
        F.when(kind == "purchase", _when("M/d/yyyy H:mm"))
        .otherwise(_when("yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .alias("starttime"),
        _when("yyyy-MM-dd HH:mm:ss").alias("stoptime"),
        F.col("user_id").alias("start station id"),
        F.concat(F.lit('The "Row",'), space, F.lit("Stop "), "user_id").alias("start station name"),
        (F.lit(42.25) + F.col("user_id") % 64 / 256).alias("start station latitude"),
        F.col("event_id").alias("bikeid"),
        F.when(kind == "click", "Subscriber").alias("usertype"),
        F.concat(F.lit("02"), F.col("user_id"), F.lit("XX")).alias("postal code"),
        (F.col("event_id") % 3).alias("gender"),
    )


def _new_files(events: DataFrame) -> DataFrame:
    """The new header, in another order and with a column of its own."""
    return events.where(~F.col("event_type").isin(*_OLD_TYPES)).select(
        F.col("event_id").alias("bike_id"),
        F.col("event_type").alias("member_casual"),
        F.concat(F.lit("S"), "user_id").alias("start_station_id"),
        _when("yyyy-MM-dd HH:mm:ss").alias("started_at"),
        _when("yyyy-MM-dd HH:mm:ss.SSS").alias("ended_at"),
    )


def _write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("nullValue", "\\N").option(
        "escape", '"'
    ).csv(path)


def _write_trips(df: DataFrame, path: str) -> None:
    """CSV files that have "trips" in their names."""
    _write_csv(df, path)
    _name_trips(df.sparkSession, path)


def _name_trips(spark: SparkSession, path: str) -> None:
    for file in list_objects(spark, path).select("path").collect():
        folder, _, name = file["path"].rpartition("/")
        rename(spark, file["path"], f"{folder}/trips-{name}")


def _raw(spark: SparkSession, sf_dir: str, new: bool = True, every: bool = False) -> str:
    """Old files with three types of events (with `every`, all), and new ones with the others."""
    root, events = scratch_path(spark, "raw"), table(spark, sf_dir, "events")
    own = events if every else events.where(F.col("event_type").isin(*_OLD_TYPES))
    _write_trips(_old_files(own), f"{root}/old")
    if new:
        _write_trips(_new_files(events), f"{root}/new")
    return root


_COLUMNS = (
    "trip_duration", "started_at", "ended_at", "start_station_id", "start_station_name",
    "start_lat", "bike_id", "user_type", "postal_code", "gender", "member_casual",
)
_OLD_SQL = """SELECT event_id % 90 * 60 AS trip_duration,
        CASE WHEN event_type <> 'purchase' THEN ts END AS started_at,
        date_trunc('second', ts) AS ended_at, cast(user_id AS varchar) AS start_station_id,
        concat('The "Row",', CASE WHEN event_id % 5 = 0 THEN chr(10) ELSE ' ' END, 'Stop ', user_id) AS start_station_name,
        42.25 + (user_id % 64)::double / 256 AS start_lat, cast(event_id AS varchar) AS bike_id,
        CASE WHEN event_type = 'click' THEN 'Subscriber' END AS user_type,
        concat('02', user_id, 'XX') AS postal_code, cast(event_id % 3 AS varchar) AS gender
    FROM events"""
_NEW_SQL = """SELECT cast(event_id AS varchar) AS bike_id, event_type AS member_casual,
        concat('S', user_id) AS start_station_id, date_trunc('second', ts) AS started_at,
        date_trunc('millisecond', ts) AS ended_at
    FROM events WHERE event_type NOT IN ('click', 'view', 'purchase')"""
_BOTH_SQL = f"{_OLD_SQL} WHERE event_type IN ('click', 'view', 'purchase') UNION ALL BY NAME {_NEW_SQL}"


def _read(spark: SparkSession, root: str) -> DataFrame:
    return read_trip_csv(trip_files(list_objects(spark, root)), [qualified(spark, root)])


@query(_OLD_SQL)
def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, _raw(spark, sf_dir, new=False, every=True)).select(*_COLUMNS[:-1])


@query(_BOTH_SQL)
def csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, _raw(spark, sf_dir)).select(*_COLUMNS)


@query(
    """SELECT event_id, CASE WHEN event_type = 'click' THEN ts
        WHEN event_type = 'view' THEN date_trunc('second', ts) END AS parsed FROM events"""
)
def lenient_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five spellings of a time; three of them are not accepted."""
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", _when("yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .when(kind == "view", _when("yyyy-MM-dd HH:mm:ss"))
        .when(kind == "purchase", _when("M/d/yyyy H:mm"))
        .when(kind == "signup", _when("yyyy-M-d HH:mm:ss"))
        .otherwise(_when("yyyy-MM-dd HH:mm"))
    )
    return table(spark, sf_dir, "events").select("event_id", parse_time(text).alias("parsed"))


@query("SELECT cast(event_id AS varchar) AS bike_id, concat('Stop ', user_id) AS start_station_name FROM events")
def nul_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NUL bytes in header and body; half of the files are clean."""
    root, events = scratch_path(spark, "raw"), table(spark, sf_dir, "events")
    for name, nul in (("dirty_trips", "\x00"), ("clean_trips", "")):
        kinds = F.col("event_type").isin(*_OLD_TYPES)
        rows = events.where(kinds if nul else ~kinds).select(
            F.concat("event_id", F.lit(nul)).alias("bikeid"),
            F.concat(F.lit(f"St{nul}op "), "user_id", F.lit(nul)).alias(f"start station {nul}name"),
        )
        _write_trips(rows, f"{root}/{name}")
    return _read(spark, root).select("bike_id", "start_station_name")


def _zip_writer(folder: str):
    """Each task packs its rows as one member, next to a later member of the same base name and a
    member that is no CSV file."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId()
        name = f"{number:05d}-trips.csv"
        with created(f"{folder}/{number:05d}.zip", f"p{number}") as out:
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
                with archive.open(f"a/{name}", "w") as member:
                    text = io.TextIOWrapper(member, encoding="utf-8", newline="")
                    text.write("bikeid,start station name\n")
                    for batch in batches:
                        batch.to_csv(text, index=False, header=False)
                    text.flush()
                    text.detach()
                archive.writestr(f"b/{name}", "bikeid,start station name\nwrong,wrong\n")
                archive.writestr("readme.txt", "no table")
        yield pd.DataFrame({"number": [number]})

    return write


@query("SELECT cast(event_id AS varchar) AS bike_id, concat('Stop ', user_id) AS start_station_name FROM events")
def zip_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed, raw = scratch_path(spark, "packed"), scratch_path(spark, "raw")
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit("Stop "), "user_id").alias("name")
    )
    folder = qualified(spark, packed)
    rows.repartition(4, "event_id").mapInPandas(_zip_writer(folder), "number int").count()
    unpack(spark, folder, raw)
    return _read(spark, raw).select("bike_id", "start_station_name")


def _by_type(spark: SparkSession, sf_dir: str) -> str:
    """One folder of files per event type."""
    root = scratch_path(spark, "raw")
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("bikeid"), F.concat("event_type", F.lit("-trips")).alias("kind")
    )
    events.write.partitionBy("kind").option("header", True).csv(root)
    _name_trips(spark, root)
    return root


@query("SELECT cast(event_id AS varchar) AS bike_id FROM events WHERE event_type = 'view'")
def list_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the files whose name starts with a prefix."""
    root = _by_type(spark, sf_dir)
    return read_trip_csv(list_objects(spark, root, "kind=view")).select("bike_id")


def _known(listing: DataFrame) -> DataFrame:
    """A manifest that lacks the clicks and holds an older time for the views."""
    older = F.when(F.col("name").startswith("kind=view"), 60).otherwise(0)
    return listing.where(~F.col("name").startswith("kind=click")).select(
        "name", (F.col("mtime") - older).alias("mtime")
    )


@query(
    """SELECT cast(event_id AS varchar) AS bike_id, CASE event_type WHEN 'click' THEN 'new'
        WHEN 'view' THEN 'changed' ELSE 'unchanged' END AS status FROM events"""
)
def manifest_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status of the file each row comes from."""
    root = _by_type(spark, sf_dir)
    listing = list_objects(spark, root)
    table_dir = scratch_path(spark, "trips")
    save_manifest(_known(listing), table_dir)
    status = classify(listing, load_manifest(spark, table_dir)).select(
        F.col("name").alias(SOURCE_FILE), "status"
    )
    return _read(spark, root).join(status, SOURCE_FILE).select("bike_id", "status")


@query(
    """SELECT bool_or(event_type = 'click') OR bool_or(event_type = 'view') AS some_to_load,
        bool_or(event_type = 'view') AS rebuild FROM events"""
)
def rebuild_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = list_objects(spark, _by_type(spark, sf_dir))
    decision = needs_rebuild(classify(listing, _known(listing)))
    return decision.select((F.col("to_load") > 0).alias("some_to_load"), "rebuild")


@query(_BOTH_SQL)
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old files, then new ones, then nothing: every row is there once."""
    root, target = _raw(spark, sf_dir, new=False), scratch_path(spark, "trips")
    update_trips(spark, [root], target)
    _write_trips(_new_files(table(spark, sf_dir, "events")), f"{root}/new")
    update_trips(spark, [root], target)
    if update_trips(spark, [root], target)["loaded"]:
        raise AssertionError("an unchanged folder was loaded again")
    return read_trips(spark, target).select(*_COLUMNS)


@query(_BOTH_SQL)
def changed_file_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table holding stale, doubled rows of files that have changed since."""
    root, target = _raw(spark, sf_dir), scratch_path(spark, "trips")
    update_trips(spark, [root], target)
    rows = _read(spark, root).where(F.col(SOURCE_FILE).startswith("old/"))
    if rows.isEmpty():
        raise AssertionError("there are no stale rows to replace")
    rows.unionByName(rows).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(SOURCE_FILE).parquet(f"{target}/data")
    listing = list_objects(spark, root)
    older = F.when(F.col("name").startswith("old/"), 60).otherwise(0)
    save_manifest(listing.withColumn("mtime", F.col("mtime") - older), target)
    if not update_trips(spark, [root], target)["loaded"]:
        raise AssertionError("changed files were not loaded again")
    return read_trips(spark, target).select(*_COLUMNS)


@query(
    sql(
        """SELECT station_id, station_name, lat, lng,
            CASE WHEN station_version < 2 THEN cast(public AS varchar) END AS public, district,
            total_docks, station_version,
            CASE station_version WHEN 0 THEN TIMESTAMP '2024-01-01' WHEN 1 THEN TIMESTAMP '2024-01-10'
                ELSE TIMESTAMP '2024-01-20' END AS effective_from FROM stations""",
        "stations",
    )
)
def station_snapshots_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three lists under two header generations; the last list lacks a column."""
    root, rows = scratch_path(spark, "lists"), stations(spark, sf_dir)
    old = {"Number": "station_id", "Name": "station_name", "Latitude": "lat", "Longitude": "lng",
           "Public": "public", "District": "district", "Total docks": "total_docks"}
    new = {"# of Docks": "total_docks", "Station": "station_name", "Station ID": "station_id",
           "Municipality": "district", "Latitude": "lat", "Longitude": "lng"}
    for version in VERSION_DATES:
        header = new if version == 2 else old
        listed = rows.where(F.col("station_version") == version)
        _write_csv(
            listed.select(*(F.col(c).alias(h) for h, c in header.items())),
            f"{root}/list{version}",
        )
    lists = {version: f"list{version}/*.csv" for version in VERSION_DATES}
    return read_stations(spark, update_stations(spark, [root], f"{root}/table", lists, VERSION_DATES))


@query(
    sql(
        """SELECT * FROM trips WHERE started_at BETWEEN TIMESTAMP '2024-01-05'
            AND TIMESTAMP '2024-01-20 23:59:59'""",
        "trips",
    )
)
def date_partitioned_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written by date, read by a range that leaves out the other dates' folders."""
    rows = trips(spark, sf_dir)
    path = save_trips(rows, scratch_path(spark, "standardized"))
    days = whole_days(datetime(2024, 1, 5), datetime(2024, 1, 20))
    return between(load_table(spark, path), "started_at", *days).select(*rows.columns)


@query("SELECT * FROM events")
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "table")
    if exists(spark, path):
        raise AssertionError("a fresh path exists")
    save_table(table(spark, sf_dir, "events"), path)
    if not exists(spark, path):
        raise AssertionError("a written table is not found")
    return load_table(spark, path)


@query(
    """SELECT * FROM (SELECT 'user_type' AS "column", 'unreadable' AS "check",
        'not bigint' AS detail, count(*) AS failures FROM events WHERE event_type = 'click')
    UNION ALL SELECT 'postal_code', 'unreadable', 'not bigint', count(*) FROM events"""
)
def unreadable_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many texts a stricter type would lose, per column."""
    rows = _read(spark, _raw(spark, sf_dir, new=False, every=True))
    types = {"user_type": "bigint", "postal_code": "bigint", "gender": "bigint"}
    return unreadable(rows, types)
