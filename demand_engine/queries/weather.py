"""Weather: schema checks, cache planning and merging, nearest stations, interpolation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demand_engine.functions.measures import distance_km
from demand_engine.functions.times import hour_of
from demand_engine.operators import weather as W
from demand_engine.operators.places import interpolate_each, interpolated_source, nearest_to_each
from demand_engine.operators.quality import violations
from demand_engine.queries.registry import query
from demand_engine.queries.views import _lat, _lng, sql, table, trips, weather
from demand_engine.schemas import TRIP_RULES, WEATHER_RULES
from demand_engine.session import scratch_path
from demand_engine.sources.weather_cache import WeatherCache

# The cache of these queries holds the middle of January; the requests reach beyond it.
_HELD = (datetime(2024, 1, 8), datetime(2024, 1, 22, 12))
_ASKED = (datetime(2024, 1, 2), datetime(2024, 1, 28))
_HELD_SQL = "time BETWEEN TIMESTAMP '2024-01-08' AND TIMESTAMP '2024-01-22 12:00:00'"
_ASKED_SQL = "time BETWEEN TIMESTAMP '2024-01-02' AND TIMESTAMP '2024-01-28'"
_BOUNDS_SQL = f"SELECT min(time) AS low, max(time) AS high FROM weather WHERE {_HELD_SQL}"


def _held(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.clamped(weather(spark, sf_dir), *_HELD)


@query(
    sql(
        """SELECT time, temp, NULL::double AS dwpt, rhu, prcp, snow, wdir, wspd,
            NULL::double AS wpgt, NULL::double AS pres, NULL::double AS tsun, NULL::double AS coco
        FROM weather""",
        "weather",
    )
)
def weather_schema_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed under its own names: text instead of numbers, NaN instead of null, columns missing."""
    feed = weather(spark, sf_dir).select(
        F.col("wspd").cast("string").alias("wspd"),
        F.coalesce("temp", F.lit(float("nan"))).alias("temp"),
        F.coalesce("snow", F.lit(float("nan"))).alias("snow"),
        "time",
        F.col("rhu").alias("rhum"),
        "prcp",
        "wdir",
    )
    return W.as_weather(feed)


@query(
    sql(
        """SELECT 'ended_at' AS "column", 'null' AS "check", 'must have a value' AS detail,
            count(*) AS failures FROM trips WHERE user_type IS NULL
        UNION ALL SELECT 'start_station_id', 'missing', 'string', 1
        UNION ALL SELECT 'end_station_id', 'missing', 'string', 1
        UNION ALL SELECT 'birth_year', 'missing', 'bigint', 1
        UNION ALL SELECT 'postal_code', 'missing', 'bigint', 1
        UNION ALL SELECT 'gender', 'type', 'string is not bigint', 1""",
        "trips",
    )
)
def schema_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trips(spark, sf_dir).withColumns(
        {
            "ended_at": F.when(F.col("user_type").isNotNull(), F.col("ended_at")),
            "gender": F.col("gender").cast("string"),
        }
    )
    return violations(rows, TRIP_RULES)


@query(
    """SELECT 'temp' AS "column", 'unreadable' AS "check", 'not double' AS detail,
        count(*) AS failures FROM events WHERE event_type = 'error'
    UNION ALL SELECT 'time', 'null', 'must have a value', count(*) FROM events
        WHERE event_type = 'view'"""
)
def weather_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    rows = table(spark, sf_dir, "events").select(
        F.when(kind != "view", F.col("ts")).alias("time"),
        F.when(kind == "error", "n/a").otherwise(F.col("value").cast("string")).alias("temp"),
    )
    return violations(rows, WEATHER_RULES)


@query(
    sql(
        f"""SELECT * FROM (
            SELECT 'head' AS part, TIMESTAMP '2024-01-02' AS from_time, low AS to_time
            FROM ({_BOUNDS_SQL}) WHERE low > TIMESTAMP '2024-01-02'
            UNION ALL SELECT 'cached', greatest(low, TIMESTAMP '2024-01-02'),
                least(high, TIMESTAMP '2024-01-28') FROM ({_BOUNDS_SQL})
            UNION ALL SELECT 'tail', high, TIMESTAMP '2024-01-28'
            FROM ({_BOUNDS_SQL}) WHERE high < TIMESTAMP '2024-01-28')""",
        "weather",
    )
)
def weather_gap_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.gaps(_held(spark, sf_dir), *_ASKED)


@query(sql(f"SELECT * FROM weather WHERE {_ASKED_SQL}", "weather"))
def weather_clamped_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.clamped(weather(spark, sf_dir), *_ASKED)


@query(
    sql(
        """SELECT time, temp, rhu, prcp, snow, wdir, wspd FROM weather WHERE prcp IS NULL
        UNION ALL SELECT time, temp + 1, rhu, NULL, snow, wdir, wspd FROM weather
            WHERE prcp IS NOT NULL""",
        "weather",
    )
)
def weather_cache_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours with rain are delivered again, with other values; a null in a new row stays null."""
    held = weather(spark, sf_dir)
    again = held.where(F.col("prcp").isNotNull()).withColumns(
        {"temp": F.col("temp") + 1, "prcp": F.lit(None).cast("double")}
    )
    return W.merge_weather([held, again])


@query(
    sql(
        f"""SELECT time, CASE WHEN time <= (SELECT high FROM ({_BOUNDS_SQL}))
                AND time >= (SELECT low FROM ({_BOUNDS_SQL}))
                AND time <> (SELECT high FROM ({_BOUNDS_SQL})) THEN temp ELSE temp + 1 END AS temp
        FROM weather WHERE {_ASKED_SQL}""",
        "weather",
    )
)
def weather_cache_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request beyond the cached times: only the gaps are fetched (marked by one degree more). The
    hour at the end of the cached times is fetched again and wins, the one at the start does not."""
    full = weather(spark, sf_dir)
    path = scratch_path(spark, "weather")
    WeatherCache(spark, path, lambda a, b: W.clamped(full, a, b)).weather(*_HELD)
    warmer = full.withColumn("temp", F.col("temp") + 1)
    cache = WeatherCache(spark, path, lambda a, b: W.clamped(warmer, a, b))
    return cache.weather(*_ASKED).select("time", "temp")


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observing stations: every supplier, some without a known place."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("station_id"),
        F.expr(_lat("s_suppkey")).alias("lat"),
        F.expr(_lng("s_suppkey")).alias("lng"),
    )


_PLACES_SQL = f"""SELECT cast(s_suppkey AS varchar) AS station_id,
        {_lat("s_suppkey").replace("42.25D", "42.25::double")} AS lat,
        {_lng("s_suppkey").replace("-71.0D", "-71.0::double")} AS lng FROM supplier"""
_HALF = "pow(sin(radians(lat - 42.36) / 2), 2) + cos(radians(lat)) * cos(radians(42.36::double)) * pow(sin(radians(lng + 71.06) / 2), 2)"
_DISTANCE_SQL = f"SELECT *, 2 * 6371.0088 * asin(sqrt({_HALF})) AS distance_km FROM ({_PLACES_SQL})"
_NEAREST_SQL = f"SELECT * FROM ({_DISTANCE_SQL}) ORDER BY distance_km NULLS LAST, station_id LIMIT 4"


@query(f"SELECT station_id, round(distance_km, 6) AS distance_km FROM ({_DISTANCE_SQL})")
def station_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = distance_km(F.col("lat"), F.col("lng"), *W.CITY_POINT)
    return _places(spark, sf_dir).select("station_id", F.round(at, 6).alias("distance_km"))


@query(f"SELECT station_id, lat, lng, round(distance_km, 6) AS distance_km FROM ({_NEAREST_SQL})")
def nearest_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = W.nearest_stations(_places(spark, sf_dir))
    return near.withColumn("distance_km", F.round("distance_km", 6))


@query(
    f"""WITH near AS ({_NEAREST_SQL}),
    seen AS (SELECT date_trunc('hour', ts) AS time, value AS temp,
            CASE WHEN event_type <> 'error' THEN value / 2 END AS wspd, distance_km AS d
        FROM events JOIN near ON station_id = cast(user_id AS varchar))
    SELECT time, round(sum(temp / (d * d)) / sum(1 / (d * d)), 6) AS temp,
        round(sum(wspd / (d * d)) / sum(CASE WHEN wspd IS NOT NULL THEN 1 / (d * d) END), 6) AS wspd
    FROM seen GROUP BY time"""
)
def interpolate_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is an observation at the station of its user."""
    estimated = W.interpolate(_observed(spark, sf_dir), _places(spark, sf_dir))
    return estimated.select("time", F.round("temp", 6).alias("temp"), F.round("wspd", 6).alias("wspd"))


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets: customers, one in eleven without a known place, the others all around the globe and near the stations."""
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("target_id"), *(F.expr(e).alias(c) for c, e in _TARGET.items()))


_TARGET = {
    "lat": "CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN c_custkey * 37 % 1800 / 10e0 - 90e0 ELSE 42.25e0 + c_custkey % 640 / 2560e0 END",
    "lng": "CASE WHEN c_custkey % 5 = 0 THEN c_custkey * 61 % 3600 / 10e0 - 180e0 ELSE -71e0 - c_custkey % 640 / 2560e0 END",
}
_TARGETS_SQL = f"SELECT c_custkey AS target_id, {', '.join(f'{e} AS {c}' for c, e in _TARGET.items())} FROM customer"
_FAR = """2 * 6371.0088 * asin(sqrt(least(1, pow(sin(radians(t.lat - s.lat) / 2), 2)
    + cos(radians(t.lat)) * cos(radians(s.lat)) * pow(sin(radians(t.lng - s.lng) / 2), 2))))"""
_NEAREST_EACH_SQL = f"""SELECT target_id, station_id, distance_km, place FROM (
    SELECT target_id, station_id, distance_km, row_number() OVER (PARTITION BY target_id ORDER BY round(distance_km, 9), station_id) AS place
    FROM (SELECT target_id, station_id, {_FAR} AS distance_km FROM ({_TARGETS_SQL}) t, ({_PLACES_SQL}) s WHERE t.lat IS NOT NULL AND s.lat IS NOT NULL))
    WHERE place <= 4"""


@query(f"SELECT target_id, place, round(distance_km, 6) AS distance_km FROM ({_NEAREST_EACH_SQL})")
def nearest_per_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four suppliers nearest to every customer; stations at one distance are told apart by `place` alone."""
    near = nearest_to_each(_customers(spark, sf_dir), _places(spark, sf_dir))
    return near.select("target_id", "place", F.round("distance_km", 6).alias("distance_km"))


def _observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is an observation at the station of its user."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("station_id"),
        hour_of(F.col("ts")).alias("time"),
        F.col("value").alias("temp"),
        F.when(F.col("event_type") != "error", F.col("value") / 2).alias("wspd"),
    )


def _estimate_sql(value: str) -> str:
    return f"""round(coalesce(avg({value}) FILTER (WHERE d = 0), sum({value} / (d * d)) FILTER (WHERE d > 0)
        / sum(CASE WHEN {value} IS NOT NULL THEN 1 / (d * d) END) FILTER (WHERE d > 0)), 6) AS {value}"""


@query(
    f"""WITH places AS ({_PLACES_SQL}), target AS (
        SELECT n_nationkey AS target_id, 42.25::double + n_nationkey / 100 + 0.0013 AS lat, -71.01::double - n_nationkey / 97 AS lng FROM nation),
    near AS (SELECT target_id, station_id, d FROM (SELECT target_id, station_id, {_FAR} AS d,
            row_number() OVER (PARTITION BY target_id ORDER BY {_FAR}, station_id) AS place
        FROM target t, places s WHERE s.lat IS NOT NULL) WHERE place <= 4),
    seen AS (SELECT target_id, date_trunc('hour', ts) AS time, value AS temp, CASE WHEN event_type <> 'error' THEN value / 2 END AS wspd, d
        FROM events JOIN near ON station_id = cast(user_id AS varchar))
    SELECT target_id, time, {_estimate_sql("temp")}, {_estimate_sql("wspd")} FROM seen GROUP BY target_id, time"""
)
def interpolate_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly weather at a point per nation, from the four stations around each."""
    key = F.col("n_nationkey")
    targets = table(spark, sf_dir, "nation").select(
        key.alias("target_id"), (F.lit(42.25) + key / 100 + F.lit(0.0013)).alias("lat"), (F.lit(-71.01) - key / 97).alias("lng")
    )
    estimated = interpolate_each(_observed(spark, sf_dir), nearest_to_each(targets, _places(spark, sf_dir)))
    return estimated.select("target_id", "time", *(F.round(c, 6).alias(c) for c in ("temp", "wspd")))


@query(
    sql(
        f"""SELECT t.ride_id, w.temp, w.wspd FROM trips t LEFT JOIN (
            SELECT time, {_estimate_sql("temp")}, {_estimate_sql("wspd")} FROM (
                SELECT date_trunc('hour', ts) AS time, value AS temp, CASE WHEN event_type <> 'error' THEN value / 2 END AS wspd, distance_km AS d
                FROM events JOIN ({_NEAREST_SQL}) near ON station_id = cast(user_id AS varchar))
            WHERE time BETWEEN TIMESTAMP '2024-01-02' AND TIMESTAMP '2024-01-28' GROUP BY time) w ON date_trunc('hour', t.started_at) = w.time""",
        "trips",
    )
)
def interpolated_trip_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prepare job's weather: asked for in two requests, estimated at the city's point, checked, cached, joined to trips."""
    source = interpolated_source(_observed(spark, sf_dir), _places(spark, sf_dir))
    cache = WeatherCache(spark, scratch_path(spark, "weather"), source)
    cache.weather(*_HELD)
    hourly = cache.weather(*_ASKED)
    joined = W.attach_weather(trips(spark, sf_dir), hourly)
    return joined.select("ride_id", F.round("temp", 6).alias("temp"), F.round("wspd", 6).alias("wspd"))
