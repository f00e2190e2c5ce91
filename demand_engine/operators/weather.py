"""Hourly weather: joining it to trips, merging versions of it, estimating it at a point."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demand_engine.functions.measures import distance_km, nan_to_null
from demand_engine.functions.times import hour_number, hour_of, ntz
from demand_engine.operators.joins import Size, left_lookup
from demand_engine.operators.quality import validate
from demand_engine.operators.tables import latest_per_key, rename_known, union_relaxed
from demand_engine.schemas import WEATHER_HEADERS, WEATHER_METRICS, WEATHER_RULES

# The point the weather is wanted for, and how many observing stations serve it.
CITY_POINT = (42.36, -71.06)
NEIGHBOURS = 4


def attach_weather(trips: DataFrame, weather: DataFrame, size: Size | None = None) -> DataFrame:
    """The weather of the hour a trip starts in; null columns where there is none."""
    # A row of weather off the full hour has no trips; the number alone would round it down.
    on_the_hour = weather.where(hour_of(F.col("time")) == F.col("time"))
    hourly = on_the_hour.withColumn("__hour", hour_number(F.col("time"))).drop("time")
    keyed = trips.withColumn("__hour", hour_number(F.col("started_at")))
    return left_lookup(keyed, hourly, ["__hour"], size).drop("__hour")


def as_weather(observations: DataFrame) -> DataFrame:
    """Observations in the declared weather schema: names, types, absent metrics, NaN as null.

    Raises when there is no row or a time is missing.
    """
    if observations.isEmpty():
        raise ValueError("no observations for this place and time")
    named = rename_known(observations, WEATHER_HEADERS)
    floats = {
        f.name: nan_to_null(F.col(f.name).cast("double"))
        for f in named.schema.fields
        if f.dataType.typeName() in ("double", "float")
    }
    return validate(named.withColumns(floats), WEATHER_RULES)


def merge_weather(parts: Sequence[DataFrame]) -> DataFrame:
    """One row per time; where parts overlap, the later part wins."""
    ranked = [p.withColumn("__part", F.lit(i)) for i, p in enumerate(parts)]
    return latest_per_key(union_relaxed(ranked), ["time"], "__part").drop("__part")


def gaps(cache: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """What a request needs: rows (part, from_time, to_time).

    `head` and `tail` lie outside the cached times and have to be fetched, `cached` is the clamped
    middle. Only parts that apply are listed; without any cached time all is `head`.
    """
    low, high = F.col("low"), F.col("high")

    def part(name: str, a, b, applies):
        entry = F.struct(
            F.lit(name).alias("part"), ntz(a).alias("from_time"), ntz(b).alias("to_time")
        )
        return F.when(applies, entry)

    parts = F.array(
        part("head", start, F.coalesce(low, ntz(end)), low.isNull() | (ntz(start) < low)),
        part("cached", F.greatest(ntz(start), low), F.least(ntz(end), high), low.isNotNull()),
        part("tail", high, end, ntz(end) > high),
    )
    bounds = cache.agg(F.min("time").alias("low"), F.max("time").alias("high"))
    return bounds.select(F.inline(F.filter(parts, lambda p: p.isNotNull())))


def clamped(cache: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """The cached rows inside the request.

    Cutting at the cached minimum and maximum as well would change nothing, since no cached row lies
    beyond them; so the bounds are plain constants here and reach the scan.
    """
    return cache.where((F.col("time") >= ntz(start)) & (F.col("time") <= ntz(end)))


def nearest_stations(
    stations: DataFrame, lat: float = CITY_POINT[0], lng: float = CITY_POINT[1], k: int = NEIGHBOURS
) -> DataFrame:
    """The k stations closest to a point, with their distance; ties go to the smaller id."""
    return (
        stations.withColumn("distance_km", distance_km(F.col("lat"), F.col("lng"), lat, lng))
        .orderBy(F.col("distance_km").asc_nulls_last(), "station_id")
        .limit(k)
    )


def weighted_mean(value: Column, distance: Column) -> Column:
    """Aggregate: the mean of known values by the inverse square of their distance; those at no distance decide alone."""
    weight = F.when(value.isNotNull() & (distance > 0), 1 / (distance * distance))
    exact = F.avg(F.when(distance == 0, value))
    return F.coalesce(exact, F.try_divide(F.sum(value * weight), F.sum(weight)))


def interpolate(
    observations: DataFrame,
    stations: DataFrame,
    lat: float = CITY_POINT[0],
    lng: float = CITY_POINT[1],
    k: int = NEIGHBOURS,
    metrics: Sequence[str] = WEATHER_METRICS,
) -> DataFrame:
    """Hourly values at a point, estimated from its k nearest stations.

    Each metric is the mean of the neighbours' known values, weighted by the inverse square of the
    distance. A neighbour at the point itself decides alone. What is broadcast has k rows.
    """
    near = nearest_stations(stations, lat, lng, k).select("station_id", "distance_km")
    reported = observations.join(F.broadcast(near), "station_id")
    present = [m for m in metrics if m in observations.columns]
    estimates = (weighted_mean(F.col(m), F.col("distance_km")).alias(m) for m in present)
    return reported.groupBy("time").agg(*estimates)
