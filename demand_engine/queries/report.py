"""Time ranges, actual against predicted demand, display numbers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demand_engine.functions.measures import elevation_scale, symmetric_max, whole_trips
from demand_engine.functions.times import day_bounds, ntz, previous_month
from demand_engine.operators import report as R
from demand_engine.operators.tables import before_time, between, from_time
from demand_engine.plans.prepare import weather_span, whole_days
from demand_engine.queries.demand import rounded
from demand_engine.queries.registry import query
from demand_engine.queries.views import _CTES, enriched, features_sql, sql, table, trips

_JANUARY = whole_days(datetime(2024, 1, 1), datetime(2024, 1, 31))
_FIFTH = datetime(2024, 1, 5)
_CUTOFF = datetime(2024, 1, 20)


def _stand_in(features: DataFrame) -> DataFrame:
    """A prediction SQL can repeat; it falls on halves and below zero."""
    return features.withColumn("prediction", F.col("actual") + F.col("hour") % 3 - F.lit(1.5))


def _report(spark: SparkSession, sf_dir: str, ordered: bool = False) -> DataFrame:
    return R.prediction_report(
        enriched(spark, sf_dir), _stand_in, *_JANUARY, order_by="ride_id", ordered=ordered
    )


_REPORT = {
    "ranged": "SELECT * FROM enriched WHERE started_at BETWEEN TIMESTAMP '2024-01-01' "
    "AND TIMESTAMP '2024-01-31 23:59:59'",
    "ranged_hours": _CTES["hours"]
    .replace("FROM enriched", "FROM ranged")
    .replace("AS demand", "AS actual"),
    "features": features_sql("ranged_hours", "actual"),
    "predictions": "SELECT *, cast(round_even(greatest(actual + hour % 3 - 1.5, 0), 0) AS bigint) "
    "AS predicted FROM features",
    "report": "SELECT *, actual - predicted AS error FROM predictions",
}
_SUMMARY = """SELECT datetime, count(*) AS stations, cast(sum(actual) AS bigint) AS actual,
        cast(sum(predicted) AS bigint) AS predicted,
        greatest(abs(min(error)), abs(max(error)), 1) AS error_max,
        CASE WHEN max(actual) > 50 THEN 5 WHEN max(actual) > 10 THEN 30 ELSE 100 END
            AS elevation_scale
    FROM report GROUP BY 1"""


def _report_sql(body: str) -> str:
    return sql(body, "enriched", **_REPORT)


@query(
    sql(
        """SELECT * FROM trips WHERE started_at BETWEEN TIMESTAMP '2024-01-05'
            AND TIMESTAMP '2024-01-20 23:59:59'""",
        "trips",
    )
)
def trips_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return between(trips(spark, sf_dir), "started_at", *whole_days(_FIFTH, _CUTOFF))


@query(
    sql(
        """SELECT ride_id, 'before' AS side FROM trips WHERE started_at < TIMESTAMP '2024-01-20'
        UNION ALL SELECT ride_id, 'from' FROM trips WHERE started_at >= TIMESTAMP '2024-01-20'""",
        "trips",
    )
)
def cutoff_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trips(spark, sf_dir).select("ride_id", "started_at")
    early = before_time(rows, "started_at", _CUTOFF).select("ride_id", F.lit("before").alias("side"))
    late = from_time(rows, "started_at", _CUTOFF).select("ride_id", F.lit("from").alias("side"))
    return early.unionByName(late)


@query(_report_sql("SELECT * FROM report ORDER BY datetime, station"))
def prediction_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_report(spark, sf_dir, ordered=True))


@query(
    _report_sql(
        """SELECT unnest(generate_series(min(datetime), max(datetime), INTERVAL 1 HOUR))
            AS datetime FROM report"""
    )
)
def hour_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.hour_axis(_report(spark, sf_dir))


@query(_report_sql("SELECT * FROM report WHERE datetime = TIMESTAMP '2024-01-15 12:00:00'"))
def hour_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(R.hour_slice(_report(spark, sf_dir), datetime(2024, 1, 15, 12)))


@query(_report_sql(_SUMMARY))
def hour_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.hour_summary(_report(spark, sf_dir))


@query(
    _report_sql(
        f"""SELECT datetime, strftime(datetime, '%Y-%m-%d %H:00') AS hour_label, stations,
            format('{{:,}}', actual) AS actual_text, format('{{:,}}', predicted) AS predicted_text
        FROM ({_SUMMARY})"""
    )
)
def hour_summary_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.summary_text(R.hour_summary(_report(spark, sf_dir)))


@query(
    _report_sql(
        """SELECT cast(greatest(abs(min(error)), abs(max(error)), 1) AS bigint) AS error_max,
            CASE WHEN max(actual) > 50 THEN 5 WHEN max(actual) > 10 THEN 30 ELSE 100 END
                AS elevation_scale FROM report"""
    )
)
def error_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir).agg(
        symmetric_max(F.col("error")).alias("error_max"),
        elevation_scale(F.max("actual")).alias("elevation_scale"),
    )


_TITLE = """array_to_string(list_transform(regexp_extract_all(station, '[a-zA-Z0-9]+|[^a-zA-Z0-9]+'),
    lambda w: upper(w[1]) || lower(w[2:])), '')"""


@query(
    _report_sql(
        f"""SELECT r.datetime, station, {_TITLE} AS station_title, lat, lng, r.actual, r.predicted,
            error, elevation_scale, 0.5 + error / (2.0 * error_max) AS error_position
        FROM report r JOIN ({_SUMMARY}) s ON r.datetime = s.datetime"""
    )
)
def map_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.map_columns(_report(spark, sf_dir))


@query(
    """SELECT o_orderkey, date_trunc('month', o_orderdate) - INTERVAL 1 MONTH AS first_day,
        date_trunc('month', o_orderdate) - INTERVAL 1 DAY AS last_day,
        date_trunc('month', o_orderdate) - INTERVAL 1 MONTH AS range_start,
        date_trunc('month', o_orderdate) - INTERVAL 1 SECOND AS range_end FROM orders"""
)
def default_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month before each order date, as days and as a closed time range."""
    days = previous_month(F.col("o_orderdate"))
    bounds = day_bounds(days["first_day"], days["last_day"])
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        *(ntz(c).alias(n) for n, c in days.items()),
        *(c.alias(n) for n, c in bounds.items()),
    )


@query(
    sql(
        """SELECT cast(date_trunc('day', min(started_at)) AS timestamp) AS first_day,
            cast(date_trunc('day', max(ended_at)) + INTERVAL 1 DAY AS timestamp) AS last_day
        FROM trips""",
        "trips",
    )
)
def weather_request_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = weather_span(trips(spark, sf_dir))
    return days.select(*(ntz(F.col(c)).alias(c) for c in days.columns))


@query(
    """SELECT event_id, cast(round_even(greatest(value - 20, 0), 0) AS bigint) AS predicted,
        cast(round_even(greatest(floor(value) - 20.5, 0), 0) AS bigint) AS halves FROM events"""
)
def clip_round_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        "event_id",
        whole_trips(value - F.lit(20)).alias("predicted"),
        whole_trips(F.floor(value) - F.lit(20.5)).alias("halves"),
    )
