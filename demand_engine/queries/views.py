"""Trips, stations and weather derived from the given tables.

Trips are events: the user is the start station, the whole part of the value the end station. A
third of the users has no supplier of that number, so those trips start at unknown stations.
Stations are suppliers in three published lists; a supplier in debt is missing from the first list,
a rich one is listed under two spellings in the last. Weather is taken from the event values of an
hour; an hour without a signup has none, and a metric is null where its event type did not occur.

`sql(...)` gives the same tables as common table expressions for DuckDB.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demand_engine.functions import names
from demand_engine.functions.times import hour_number, hour_time
from demand_engine.operators.stations import station_version
from demand_engine.plans.prepare import enrich
from demand_engine.session import cut_lineage

# The events cover January 2024, so the lists of these tables take effect within it.
VERSION_DATES = {0: datetime(2024, 1, 1), 1: datetime(2024, 1, 10), 2: datetime(2024, 1, 20)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _raw_name(key: str, street: str) -> str:
    return (
        f"concat(CASE {key} % 5 WHEN 0 THEN 'North ' WHEN 1 THEN 'Massachusetts Ave/' "
        "WHEN 2 THEN 'MIT @ ' WHEN 3 THEN 'St. Mary''s & ' ELSE 'South Station - ' END, "
        f"'Row ', {street}, ' (former) Stop-', cast({key} AS STRING))"
    )


def _lat(key: str) -> str:
    return (
        f"CASE WHEN {key} % 11 = 0 THEN NULL ELSE 42.25D + cast({key} % 64 AS double) / 256 END"
    )


def _lng(key: str) -> str:
    return f"-71.0D - cast({key} % 64 AS double) / 256"


_STREET = "CASE WHEN event_type IN ('click', 'view') THEN 'Street' ELSE 'St.' END"
_END = "cast(floor(value) AS bigint)"
_TRIP_COLUMNS = {
    "ride_id": "event_id",
    "started_at": "ts",
    "ended_at": "ts + make_dt_interval(0, 0, 1 + event_id % 90, 0)",
    "start_station_name": _raw_name("user_id", _STREET),
    "start_lat": _lat("user_id"),
    "start_lng": _lng("user_id"),
    "end_station_name": _raw_name(_END, "'Street'"),
    "end_lat": _lat(_END),
    "end_lng": _lng(_END),
    "user_type": "CASE event_type WHEN 'click' THEN 'subscriber' WHEN 'view' THEN 'customer' "
    "WHEN 'purchase' THEN 'member' WHEN 'signup' THEN 'Subscriber' END",
    "gender": "event_id % 4",
}
_STATION_COLUMNS = {
    "station_id": "cast(s_suppkey AS STRING)",
    "station_name": _raw_name("s_suppkey", "street"),
    "lat": _lat("s_suppkey"),
    "lng": _lng("s_suppkey"),
    "public": "s_acctbal >= 5000",
    "district": "n_name",
    "total_docks": "10 + s_suppkey % 20 + v",
    "station_version": "v",
}
_LISTED = "NOT (v = 0 AND s_acctbal < 0)"
_STREETS = (
    "CASE WHEN v = 0 THEN {a}'Street'{z} WHEN v = 2 AND s_acctbal > 9000 "
    "THEN {a}'St.', 'Street'{z} ELSE {a}'St.'{z} END"
)
# Metric -> aggregate of the hour's events.
WEATHER_VALUES = {
    "temp": "max(value) FILTER (WHERE event_type = 'view')",
    "rhu": "max(value) FILTER (WHERE event_type = 'click')",
    "prcp": "max(value) FILTER (WHERE event_type = 'purchase')",
    "snow": "min(value) FILTER (WHERE event_type = 'purchase')",
    "wdir": "min(value) FILTER (WHERE event_type = 'click')",
    "wspd": "min(value) FILTER (WHERE event_type = 'view')",
}
_OBSERVED = "count(*) FILTER (WHERE event_type = 'signup')"


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        *(F.expr(e).alias(c) for c, e in _TRIP_COLUMNS.items())
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.expr("s_nationkey = n_nationkey"))
        .withColumn("v", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
        .where(_LISTED)
        .withColumn("street", F.explode(F.expr(_STREETS.format(a="array(", z=")"))))
    )
    return listed.select(*(F.expr(e).alias(c) for c, e in _STATION_COLUMNS.items()))


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = {**WEATHER_VALUES, "observed": _OBSERVED}
    hourly = (
        table(spark, sf_dir, "events")
        .groupBy(hour_number(F.col("ts")).alias("number"))
        .agg(*(F.expr(e).alias(c) for c, e in values.items()))
    )
    return hourly.where(F.col("observed") > 0).select(
        hour_time(F.col("number")).alias("time"), *WEATHER_VALUES
    )


def version(column: str):
    return station_version(column, VERSION_DATES)


def station_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stations as a written table, as the jobs read them; joins look at it several times."""
    return cut_lineage(stations(spark, sf_dir))


def enriched(spark: SparkSession, sf_dir: str, rides: DataFrame | None = None) -> DataFrame:
    """Trips (those of the tables, or `rides`) with all attributes, from written stations and weather."""
    return enrich(
        trips(spark, sf_dir) if rides is None else rides,
        station_table(spark, sf_dir),
        cut_lineage(weather(spark, sf_dir)),
        VERSION_DATES,
    )


# The same in SQL.


def _duck(expression: str) -> str:
    return (
        expression.replace("42.25D", "42.25::double")
        .replace("-71.0D", "-71.0::double")
        .replace("make_dt_interval(0, 0, 1 + event_id % 90, 0)", "to_minutes(1 + event_id % 90)")
    )


def _listing(columns: dict[str, str]) -> str:
    return ", ".join(f"{_duck(e)} AS {c}" for c, e in columns.items())


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def mapped_sql(value: str, mapping: dict[str, str]) -> str:
    cases = " ".join(f"WHEN {_quote(k)} THEN {_quote(v)}" for k, v in mapping.items())
    return f"CASE {value} {cases} ELSE {value} END"


def literals_sql(value: str) -> str:
    for old, new in names.LITERALS.items():
        value = f"replace({value}, {_quote(old)}, {_quote(new)})"
    return value


def clean_sql(value: str) -> str:
    words = f"list_filter(string_split({literals_sql(f'lower({value})')}, ' '), lambda w: w <> '')"
    mapped = f"list_transform({words}, lambda w: {mapped_sql('w', names.WORDS)})"
    return f"(SELECT {mapped_sql('j', names.ALIASES)} FROM (SELECT array_to_string({mapped}, ' ') AS j))"


def version_sql(column: str) -> str:
    return (
        f"CASE WHEN {column} >= TIMESTAMP '2024-01-20' THEN 2 "
        f"WHEN {column} >= TIMESTAMP '2024-01-10' THEN 1 ELSE 0 END"
    )


_CTES = {
    "trips": f"SELECT {_listing(_TRIP_COLUMNS)} FROM events",
    "stations": f"""
        SELECT {_listing(_STATION_COLUMNS)} FROM (
            SELECT *, unnest({_STREETS.format(a="[", z="]")}) AS street
            FROM supplier JOIN nation ON s_nationkey = n_nationkey
            CROSS JOIN (VALUES (0), (1), (2)) versions(v) WHERE {_LISTED})""",
    "weather": f"""
        SELECT date_trunc('hour', ts) AS time, {_listing(WEATHER_VALUES)}
        FROM events GROUP BY 1 HAVING {_OBSERVED} > 0""",
    "station_map": f"""
        SELECT station_name, {clean_sql("station_name")} AS clean_station_name
        FROM (SELECT DISTINCT station_name FROM stations)""",
    "clean_stations": """
        SELECT m.clean_station_name AS station_name, total_docks, station_version, public, district
        FROM stations s JOIN station_map m ON s.station_name = m.station_name""",
    "normal_trips": f"""
        SELECT t.* REPLACE (
            coalesce(a.clean_station_name, t.start_station_name) AS start_station_name,
            coalesce(b.clean_station_name, t.end_station_name) AS end_station_name,
            {mapped_sql("user_type", names.USER_TYPES)} AS user_type,
            {mapped_sql("cast(gender AS varchar)", names.GENDERS)} AS gender),
            {version_sql("started_at")} AS start_station_version,
            {version_sql("ended_at")} AS end_station_version
        FROM trips t
        LEFT JOIN station_map a ON t.start_station_name = a.station_name
        LEFT JOIN station_map b ON t.end_station_name = b.station_name""",
    "standard_trips": """
        SELECT t.*, a.total_docks AS start_station_total_docks, a.public AS start_station_public,
            a.district AS start_district, b.total_docks AS end_station_total_docks,
            b.public AS end_station_public, b.district AS end_district
        FROM normal_trips t
        LEFT JOIN clean_stations a ON a.station_name = t.start_station_name
            AND a.station_version = t.start_station_version
        LEFT JOIN clean_stations b ON b.station_name = t.end_station_name
            AND b.station_version = t.end_station_version""",
    "enriched": """
        SELECT t.*, w.* EXCLUDE (time) FROM standard_trips t
        LEFT JOIN weather w ON date_trunc('hour', t.started_at) = w.time""",
    "hours": """
        SELECT date_trunc('hour', started_at) AS datetime, start_station_name AS station,
            count(*) AS demand, arg_min_null(start_lat, ride_id) AS lat,
            arg_min_null(start_lng, ride_id) AS lng,
            arg_min_null(start_station_total_docks, ride_id) AS total_docks,
            arg_min_null(prcp, ride_id) AS prcp, arg_min_null(snow, ride_id) AS snow,
            arg_min_null(temp, ride_id) AS temp, arg_min_null(rhu, ride_id) AS rhu,
            arg_min_null(wspd, ride_id) AS wspd, arg_min_null(wdir, ride_id) AS wdir
        FROM enriched GROUP BY 1, 2""",
}
_NEEDS = {
    "station_map": ("stations",),
    "clean_stations": ("station_map",),
    "normal_trips": ("trips", "station_map"),
    "standard_trips": ("normal_trips", "clean_stations"),
    "enriched": ("standard_trips", "weather"),
    "hours": ("enriched",),
}


def features_sql(hours: str = "hours", count: str = "demand") -> str:
    """The feature table over a station-hour table, values rounded to six places."""
    filled = ", ".join(
        f"round(coalesce({c}, {'0' if c in ('prcp', 'snow') else f'(SELECT avg({c}) FROM {hours})'}), 6) AS {c}"
        for c in ("prcp", "snow", "temp", "rhu", "wspd", "wdir")
    )
    return f"""
        SELECT datetime, station, {count}, lat, lng, total_docks, {filled},
            cast(hour(datetime) AS int) AS hour, cast(isodow(datetime) AS int) AS weekday,
            cast(month(datetime) AS int) AS month, cast(year(datetime) AS int) AS year,
            isodow(datetime) IN (5, 6) AS is_weekend
        FROM {hours}
        WHERE datetime IS NOT NULL AND station IS NOT NULL AND lat IS NOT NULL AND lng IS NOT NULL
            AND total_docks IS NOT NULL"""


def sql(body: str, *views: str, **extra: str) -> str:
    """`body` after the common table expressions it names; `extra` adds own ones."""
    order: list[str] = []

    def add(view: str) -> None:
        for need in _NEEDS.get(view, ()):
            add(need)
        if view not in order:
            order.append(view)

    for view in views:
        add(view)
    parts = [f"{v} AS ({_CTES[v]})" for v in order] + [f"{n} AS ({q})" for n, q in extra.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
