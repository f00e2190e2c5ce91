"""Station-hour demand and its features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demand_engine.functions.times import hour_of
from demand_engine.operators.demand import (
    add_calendar,
    demand_features,
    fill_missing,
    station_hours,
)
from demand_engine.operators.tables import latest_per_key, span, without_nulls
from demand_engine.operators.weather import attach_weather
from demand_engine.queries.registry import query
from demand_engine.queries.views import (
    enriched,
    features_sql,
    sql,
    table,
    trips,
    weather,
)
from demand_engine.schemas import WEATHER_FILLS


def rounded(df: DataFrame, columns=tuple(WEATHER_FILLS)) -> DataFrame:
    """Means depend on the order of addition in their last digits, so outputs are rounded."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query(
    sql(
        """SELECT date_trunc('hour', started_at) AS datetime, start_station_name AS station,
            count(*) AS demand, arg_min_null(start_lat, ride_id) AS lat,
            arg_min_null(start_lng, ride_id) AS lng,
            arg_min_null(gender, ride_id) AS first_gender
        FROM trips GROUP BY 1, 2""",
        "trips",
    )
)
def station_hour_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = {"start_lat": "lat", "start_lng": "lng", "gender": "first_gender"}
    return station_hours(trips(spark, sf_dir), "ride_id", firsts=first)


@query(sql(features_sql() + " ORDER BY datetime, station", "hours"))
def station_hour_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(demand_features(enriched(spark, sf_dir), "ride_id"))


@query(
    sql(
        """SELECT ride_id, started_at, time IS NOT NULL AS has_weather,
            w.* EXCLUDE (time)
        FROM trips t LEFT JOIN weather w ON date_trunc('hour', started_at) = time""",
        "trips",
        "weather",
    )
)
def weather_hour_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = weather(spark, sf_dir).withColumn("found", F.lit(True))
    joined = attach_weather(trips(spark, sf_dir), marked)
    return joined.select(
        "ride_id",
        "started_at",
        F.col("found").isNotNull().alias("has_weather"),
        *WEATHER_FILLS,
    )


@query(
    """SELECT event_id, ts, cast(hour(ts) AS int) AS hour, cast(isodow(ts) AS int) AS weekday,
        cast(month(ts) AS int) AS month, cast(year(ts) AS int) AS year,
        isodow(ts) IN (5, 6) AS is_weekend FROM events"""
)
def calendar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_calendar(table(spark, sf_dir, "events").select("event_id", "ts"), "ts")


@query("SELECT event_id, date_trunc('hour', ts) AS hour_start FROM events")
def truncate_to_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", hour_of(F.col("ts")).alias("hour_start")
    )


@query(
    sql(
        """SELECT time, coalesce(prcp, 0) AS prcp, coalesce(snow, 0) AS snow,
            round(coalesce(temp, (SELECT avg(temp) FROM weather)), 6) AS temp,
            round(coalesce(rhu, (SELECT avg(rhu) FROM weather)), 6) AS rhu,
            round(coalesce(wspd, (SELECT avg(wspd) FROM weather)), 6) AS wspd,
            round(coalesce(wdir, (SELECT avg(wdir) FROM weather)), 6) AS wdir
        FROM weather""",
        "weather",
    )
)
def weather_fills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(fill_missing(weather(spark, sf_dir)), ("temp", "rhu", "wspd", "wdir"))


@query(
    sql(
        """SELECT * FROM weather WHERE time IS NOT NULL AND temp IS NOT NULL AND rhu IS NOT NULL
            AND prcp IS NOT NULL AND snow IS NOT NULL AND wdir IS NOT NULL AND wspd IS NOT NULL""",
        "weather",
    )
)
def complete_weather_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_nulls(weather(spark, sf_dir))


@query(
    sql("SELECT min(started_at) AS min_time, max(ended_at) AS max_time FROM trips", "trips")
)
def trip_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span(trips(spark, sf_dir))


@query(
    """SELECT user_id, max(event_id) AS event_id, arg_max_null(event_type, event_id) AS event_type,
        arg_max_null(value, event_id) AS value FROM events GROUP BY 1"""
)
def keep_last_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    return latest_per_key(rows, ["user_id"], "event_id")
