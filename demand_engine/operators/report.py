"""Actual against predicted demand, and the numbers shown about it."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demand_engine.functions.measures import (
    diverging_position,
    elevation_scale,
    grouped_digits,
    prediction_error,
    symmetric_max,
    whole_trips,
)
from demand_engine.functions.names import title_case
from demand_engine.functions.times import hour_label, ntz
from demand_engine.operators.demand import demand_features
from demand_engine.operators.tables import between, whole_rows

Scorer = Callable[[DataFrame], DataFrame]


def prediction_report(
    trips: DataFrame,
    score: Scorer,
    start: datetime,
    end: datetime,
    order_by: str | Column | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Station-hours of a closed time range with `actual`, `predicted` and `error`.

    `score` adds a `prediction` column to the feature table (`modeling.scorer` makes one from a
    model). A range without trips gives an empty table of the same columns.
    """
    features = demand_features(
        between(trips, "started_at", start, end), order_by, count_name="actual", ordered=False
    )
    columns = features.columns
    predicted = score(features).withColumn("predicted", whole_trips(F.col("prediction")))
    rows = predicted.select(
        *columns,
        "predicted",
        prediction_error(F.col("actual"), F.col("predicted")).alias("error"),
    )
    return rows.orderBy("datetime", "station") if ordered else rows


def hour_axis(report: DataFrame, time_col: str = "datetime") -> DataFrame:
    """Every full hour between the first and the last one reported, with or without rows."""
    bounds = report.agg(F.min(time_col).alias("low"), F.max(time_col).alias("high"))
    return bounds.where(F.col("low").isNotNull()).select(
        F.explode(F.sequence("low", "high", F.expr("INTERVAL 1 HOUR"))).alias(time_col)
    )


def hour_slice(report: DataFrame, at: datetime) -> DataFrame:
    return report.where(F.col("datetime") == ntz(at))


def hour_summary(report: DataFrame) -> DataFrame:
    """One row per hour: stations, trips, and the scales its map uses."""
    return report.groupBy("datetime").agg(
        F.count(F.lit(1)).alias("stations"),
        F.sum("actual").alias("actual"),
        F.sum("predicted").alias("predicted"),
        symmetric_max(F.col("error")).alias("error_max"),
        elevation_scale(F.max("actual")).cast("int").alias("elevation_scale"),
    )


def summary_text(summary: DataFrame) -> DataFrame:
    """The summary as shown: hour label and grouped digits."""
    return summary.select(
        "datetime",
        hour_label(F.col("datetime")).alias("hour_label"),
        F.col("stations"),
        grouped_digits(F.col("actual")).alias("actual_text"),
        grouped_digits(F.col("predicted")).alias("predicted_text"),
    )


def map_columns(report: DataFrame) -> DataFrame:
    """The rows of all hours with display name, colour position and column height multiplier.

    The scales come from a join with the hourly summary, not from a window, so that an hour with
    very many stations is not sorted into one task.
    """
    report = whole_rows(report)
    scales = hour_summary(report).select(
        F.col("datetime").alias("__datetime"), "error_max", "elevation_scale"
    )
    # Null-safe, since a plain equality would add a filter to one branch only.
    same_hour = F.col("datetime").eqNullSafe(F.col("__datetime"))
    return report.join(scales, same_hour).select(
        "datetime",
        "station",
        title_case(F.col("station")).alias("station_title"),
        "lat",
        "lng",
        "actual",
        "predicted",
        "error",
        "elevation_scale",
        diverging_position(F.col("error"), F.col("error_max")).alias("error_position"),
    )
