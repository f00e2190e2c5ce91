"""Station-hour demand and its features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demand_engine.functions.times import calendar, hour_number, hour_time
from demand_engine.operators.tables import whole_rows, without_nulls
from demand_engine.schemas import MEAN, WEATHER_FILLS, WEEKEND_DAYS

# Trip column -> column of the station-hour table; its value is that of the group's first trip.
FIRST_OF_TRIP = {
    "start_lat": "lat",
    "start_lng": "lng",
    "start_station_total_docks": "total_docks",
}


def trip_order(columns: Sequence[str]) -> Column:
    """Order of the trips of one hour, as one number: start time, then a hash of the given columns.

    Trips that tie in both are alike in those columns but for one chance in 2^31.
    """
    micros = F.pmod(F.unix_micros(F.col("started_at").cast("timestamp")), F.lit(3_600_000_000))
    content = F.pmod(F.xxhash64(*(F.col(c) for c in columns)), F.lit(1 << 31))
    return micros * F.lit(1 << 31) + content


def station_hours(
    trips: DataFrame,
    order_by: str | Column | None = None,
    count_name: str = "demand",
    firsts: Mapping[str, str] | None = None,
) -> DataFrame:
    """Trips per hour and start station, with the place and weather of the first trip in each.

    `firsts` lists what to take from that trip, input column -> output column.

    `order_by` decides which trip is first, a number or time that should be unique. Without it the
    first to start is, and among those the one with the least hash of what is taken from it, so that
    the result does not depend on the run. All values and the order key are fixed-width, so that Spark
    aggregates in a hash map before the shuffle: a busy station adds one row per task and hour, not
    one per trip.
    """
    if firsts is None:
        firsts = FIRST_OF_TRIP | {c: c for c in WEATHER_FILLS}
    key = F.col(order_by) if isinstance(order_by, str) else order_by
    if key is None:
        key = trip_order(list(firsts))
    hours = trips.groupBy(
        hour_number(F.col("started_at")).alias("__hour"),
        F.col("start_station_name").alias("station"),
    ).agg(
        F.count(F.lit(1)).alias(count_name),
        *(F.min_by(source, key).alias(name) for source, name in firsts.items()),
    )
    return hours.select(
        hour_time(F.col("__hour")).alias("datetime"), "station", count_name, *firsts.values()
    )


def column_means(df: DataFrame, columns: Sequence[str]) -> Column:
    """The means of some columns over the whole table, as a struct in a scalar subquery."""
    means = F.struct(*(F.avg(c).alias(c) for c in columns)).alias("means")
    return df.agg(means).scalar()


def fill_missing(
    df: DataFrame, fills: Mapping[str, float | str] = WEATHER_FILLS
) -> DataFrame:
    """Replace nulls (not NaN) by a constant, or by the mean over all rows of `df`."""
    averaged = [c for c, how in fills.items() if how == MEAN]
    means = column_means(df, averaged) if averaged else None
    return df.withColumns(
        {
            c: F.coalesce(c, means[c] if how == MEAN else F.lit(how).cast("double"))
            for c, how in fills.items()
        }
    )


def fitted_fills(
    df: DataFrame, fills: Mapping[str, float | str] = WEATHER_FILLS
) -> dict[str, float]:
    """The fill values of a table as numbers, to apply them to another one (no look-ahead)."""
    averaged = [c for c, how in fills.items() if how == MEAN]
    means = df.agg(*(F.avg(c).alias(c) for c in averaged)).first().asDict() if averaged else {}
    return {c: means[c] if how == MEAN else how for c, how in fills.items()}


def add_calendar(
    df: DataFrame, time_col: str = "datetime", weekend_days: Sequence[int] = WEEKEND_DAYS
) -> DataFrame:
    return df.withColumns(calendar(F.col(time_col), weekend_days))


def demand_features(
    trips: DataFrame,
    order_by: str | Column | None = None,
    count_name: str = "demand",
    fills: Mapping[str, float | str] = WEATHER_FILLS,
    weekend_days: Sequence[int] = WEEKEND_DAYS,
    ordered: bool = True,
) -> DataFrame:
    """The feature table: one complete row per station and hour, by time.

    Means are taken over all station-hours, before incomplete rows are dropped. Whole rows and an
    unmoved null filter keep the plan under the means the same as the main one, so the trips are
    scanned and shuffled once. `ordered=False` leaves out the sort where the order is of no use, as
    for training.
    """
    hours = whole_rows(
        station_hours(trips, order_by, count_name, FIRST_OF_TRIP | {c: c for c in fills})
    )
    filled = fill_missing(hours, fills).transform(add_calendar, "datetime", weekend_days)
    rows = without_nulls(filled, pushed=False)
    return rows.orderBy("datetime", "station") if ordered else rows
