"""Nearest places of many targets, and values at the targets estimated from them."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demand_engine.functions.measures import EARTH_RADIUS_KM, distance_between
from demand_engine.operators.tables import between
from demand_engine.operators.weather import CITY_POINT, NEIGHBOURS, weighted_mean
from demand_engine.schemas import WEATHER_METRICS
from demand_engine.session import cut_lineage

#: The first grid has 2 ** FINEST columns around the globe (cells of 0.09 degrees), each later one half as many.
FINEST = 12


def _cell(lat: Column, lng: Column, columns: int) -> Column:
    size = 360.0 / columns
    x = F.pmod(F.floor((lng + 180) / size), F.lit(columns))
    return F.struct(x.alias("x"), F.floor((lat + 90) / size).alias("y"))


def _around(cell: Column, columns: int) -> Column:
    """The cell and its neighbours; columns go on around the globe."""
    cells = [
        F.struct(F.pmod(cell["x"] + dx, F.lit(columns)).alias("x"), (cell["y"] + dy).alias("y")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)
    ]
    return F.array_distinct(F.array(*cells))


def _certain_km(lat: Column, columns: int) -> Column:
    """No place outside a cell's neighbours is nearer than this: a cell's height, or the way to the meridian a cell's width off."""
    size = math.radians(360.0 / columns)
    across = F.asin(F.lit(math.sin(min(size, math.pi / 2))) * F.cos(F.radians(lat)))
    return F.lit(EARTH_RADIUS_KM) * F.least(F.lit(size), across)


def nearest_to_each(
    targets: DataFrame, stations: DataFrame, k: int = NEIGHBOURS, finest: int = FINEST
) -> DataFrame:
    """(target_id, station_id, distance_km, place): the k nearest of `stations` (station_id, lat, lng) to each
    of `targets` (target_id, lat, lng), the nearest at place 1; ties go to the smaller id.

    A target meets the stations of its cell and the eight around it. It is done when its k nearest are nearer
    than anything outside can be; the rest go on with cells twice as wide, in the end with the whole globe.
    Targets at one point are looked up once, and of stations at one point only the k least ids can matter, so
    that a hot point costs no more than any other. Rows without coordinates take no part; a target has fewer
    than k rows where there are fewer stations.
    """
    known = F.col("lat").isNotNull() & F.col("lng").isNotNull()
    spots = cut_lineage(targets.where(known).select("lat", "lng").distinct())
    at_point = Window.partitionBy("lat", "lng").orderBy("station_id")
    sites = cut_lineage(
        stations.where(known).select("station_id", "lat", "lng").withColumn("n", F.row_number().over(at_point)).where(F.col("n") <= k).drop("n")
    )
    left, found = spots, []
    by_distance = Window.partitionBy("lat", "lng").orderBy("distance_km", "station_id")
    for level in range(finest, -1, -1):
        columns = 2**level
        near = sites.select("station_id", F.col("lat").alias("to_lat"), F.col("lng").alias("to_lng"), _cell(F.col("lat"), F.col("lng"), columns).alias("cell"))
        asked = left.withColumn("cell", F.explode(_around(_cell(F.col("lat"), F.col("lng"), columns), columns)))
        pairs = asked.join(near, "cell").withColumn("distance_km", distance_between(F.col("lat"), F.col("lng"), F.col("to_lat"), F.col("to_lng")))
        ranked = pairs.withColumn("place", F.row_number().over(by_distance)).where(F.col("place") <= k)
        ranked = cut_lineage(ranked.select("lat", "lng", "station_id", "distance_km", "place"))
        certain = (F.count(F.lit(1)) == k) & (F.max("distance_km") < F.first(_certain_km(F.col("lat"), columns)))
        done = ranked.groupBy("lat", "lng").agg((F.lit(level == 0) | certain).alias("done")).where("done").drop("done")
        found.append(ranked.join(done, ["lat", "lng"], "left_semi"))
        left = cut_lineage(left.join(done, ["lat", "lng"], "left_anti"))
        if left.isEmpty():
            break
    nearest = cut_lineage(reduce(DataFrame.unionByName, found))
    return targets.select("target_id", "lat", "lng").join(nearest, ["lat", "lng"]).select("target_id", "station_id", "distance_km", "place")


def interpolate_each(
    observations: DataFrame, nearest: DataFrame, metrics: Sequence[str] = WEATHER_METRICS
) -> DataFrame:
    """(target_id, time, metrics): hourly values at each target from its nearest stations, see `weather.interpolate`.

    `nearest` has (target_id, station_id, distance_km), as `nearest_to_each` gives it.
    """
    present = [m for m in metrics if m in observations.columns]
    weights = nearest.select("target_id", "station_id", "distance_km")
    reported = observations.select("station_id", "time", *present).join(weights, "station_id")
    estimates = (weighted_mean(F.col(m), F.col("distance_km")).alias(m) for m in present)
    return reported.groupBy("target_id", "time").agg(*estimates)


def interpolated_source(
    observations: DataFrame, stations: DataFrame, point: tuple[float, float] = CITY_POINT, k: int = NEIGHBOURS
) -> Callable[[datetime, datetime], DataFrame]:
    """A weather source for jobs: what is asked for is estimated at a point from the observing stations around it."""
    spark = observations.sparkSession
    target = spark.createDataFrame([(0, *map(float, point))], "target_id int, lat double, lng double")

    def source(start: datetime, end: datetime) -> DataFrame:
        asked = between(observations, "time", start, end)
        return interpolate_each(asked, nearest_to_each(target, stations, k)).drop("target_id")

    return source
