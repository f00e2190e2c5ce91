from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from demand_engine.operators import weather as W
from demand_engine.sources.weather_cache import WeatherCache


def at(hour, minute=0, day=1):
    return datetime(2024, 1, day, hour, minute)


def trips(spark, *times):
    return spark.createDataFrame([(t,) for t in times], "started_at timestamp_ntz")


def temps(df, key="started_at"):
    return {r[key]: r["temp"] for r in df.collect()}


def test_all_metrics_arrive(spark):
    weather = spark.createDataFrame(
        [(at(14), 20.0, 65.0, 5.5)], "time timestamp_ntz, temp double, rhu double, wspd double"
    )
    got = W.attach_weather(trips(spark, at(14, 30)), weather)
    assert got.columns == ["started_at", "temp", "rhu", "wspd"]
    assert tuple(got.first())[1:] == (20.0, 65.0, 5.5)


def test_outside_hours_have_none_and_hours_are_matched(spark):
    weather = spark.createDataFrame(
        [(at(14), 20.0), (at(16), 22.0)], "time timestamp_ntz, temp double"
    )
    given = [at(13, 59), at(14), at(14, 15), at(14, 45), at(15, 1), at(16, 59), None]
    assert temps(W.attach_weather(trips(spark, *given), weather)) == dict(
        zip(given, [None, 20.0, 20.0, 20.0, None, 22.0, None])
    )


def test_weather_off_the_hour_matches_nothing(spark):
    weather = spark.createDataFrame(
        [(at(14, 30), 20.0), (None, 1.0)], "time timestamp_ntz, temp double"
    )
    assert temps(W.attach_weather(trips(spark, at(14, 45), None), weather)) == {
        at(14, 45): None, None: None,
    }


def test_newer_part_wins_and_nulls_count(spark):
    old = spark.createDataFrame(
        [(at(1), 1.0), (at(2), 2.0), (None, 3.0)], "time timestamp_ntz, temp double"
    )
    new = spark.createDataFrame(
        [(at(2), None, 0.5), (None, 4.0, 0.5)], "time timestamp_ntz, temp double, prcp double"
    )
    got = {r["time"]: (r["temp"], r["prcp"]) for r in W.merge_weather([old, new]).collect()}
    assert got == {at(1): (1.0, None), at(2): (None, 0.5), None: (4.0, 0.5)}


def test_observations_are_checked(spark):
    raw = spark.createDataFrame(
        [(at(0), 50.0, 1.0), (at(1), float("nan"), 2.0)],
        "time timestamp_ntz, rhum double, temp double",
    )
    got = W.as_weather(raw).orderBy("time").collect()
    assert [r["rhu"] for r in got] == [50.0, None]
    assert len(got[0]) == 12
    with pytest.raises(ValueError, match="no observations"):
        W.as_weather(raw.where("temp > 5"))


@pytest.mark.parametrize(
    ("start", "end", "parts"),
    [
        (at(0, day=1), at(0, day=9), ["head", "cached", "tail"]),
        (at(0, day=4), at(0, day=5), ["cached"]),
        (at(0, day=3), at(0, day=6), ["cached"]),
        (at(0, day=1), at(0, day=5), ["head", "cached"]),
        (at(0, day=4), at(0, day=7), ["cached", "tail"]),
    ],
)
def test_gaps(spark, start, end, parts):
    cache = spark.createDataFrame(
        [(at(0, day=3), 1.0), (at(0, day=6), 2.0)], "time timestamp_ntz, temp double"
    )
    rows = W.gaps(cache, start, end).collect()
    assert [r["part"] for r in rows] == parts
    low, high = at(0, day=3), at(0, day=6)
    bounds = {r["part"]: (r["from_time"], r["to_time"]) for r in rows}
    assert bounds["cached"] == (max(start, low), min(end, high))
    assert bounds.get("head", (start, low)) == (start, low)
    assert bounds.get("tail", (high, end)) == (high, end)


def test_gap_of_an_empty_cache_is_everything(spark):
    cache = spark.createDataFrame([], "time timestamp_ntz, temp double")
    assert [tuple(r) for r in W.gaps(cache, at(1), at(2)).collect()] == [("head", at(1), at(2))]


def test_cache_fetches_only_what_it_lacks(spark, tmp_path):
    asked = []

    def source(start, end):
        asked.append((start, end))
        hours = spark.createDataFrame([(start, end)], "a timestamp_ntz, b timestamp_ntz").select(
            F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 HOUR"))).alias("time")
        )
        return hours.withColumn("temp", F.lit(float(len(asked))))

    cache = WeatherCache(spark, str(tmp_path / "weather"), source)
    first = temps(cache.weather(at(5), at(10)), "time")
    assert len(first) == 6 and asked == [(at(5), at(10))]

    inner = temps(cache.weather(at(6), at(8)), "time")
    assert sorted(inner) == [at(6), at(7), at(8)] and len(asked) == 1

    wide = temps(cache.weather(at(3), at(12)), "time")
    assert asked[1:] == [(at(3), at(5)), (at(10), at(12))]
    assert len(wide) == 10
    assert wide[at(4)] == 2.0 and wide[at(5)] == 1.0  # the cached row beats the one before it
    assert wide[at(10)] == 3.0 and wide[at(9)] == 1.0  # a fetched row beats the one at the end
    stored = temps(cache.cached(), "time")
    assert stored[at(5)] == 2.0  # in the table fetched rows win

    again = temps(cache.weather(at(3), at(12)), "time")
    assert len(asked) == 3 and len(again) == 10


def test_an_unfinished_version_is_ignored(spark, tmp_path):
    path = tmp_path / "weather"

    def source(start, end):
        return spark.createDataFrame([(start, 1.0)], "time timestamp_ntz, temp double")

    cache = WeatherCache(spark, str(path), source)
    cache.weather(at(1), at(2))
    (path / "v=2").mkdir()
    assert cache.cached().count() == 1
    assert cache.upsert([W.as_weather(source(at(3), at(4)))]).count() == 2


def places(spark, *rows):
    return spark.createDataFrame(rows, "station_id string, lat double, lng double")


def test_nearest(spark):
    stations = places(
        spark, ("far", 43.0, -71.0), ("b", 42.36, -71.07), ("a", 42.36, -71.05), ("none", None, None)
    )
    got = W.nearest_stations(stations, 42.36, -71.06, 2).collect()
    assert {r["station_id"] for r in got} == {"a", "b"}
    assert W.nearest_stations(stations).count() == 4


def test_interpolation_weighs_and_skips_nulls(spark):
    stations = places(spark, ("a", 42.0, -71.0), ("b", 42.0, -71.3), ("c", 42.0, -72.5))
    seen = spark.createDataFrame(
        [("a", at(1), 10.0), ("b", at(1), 20.0), ("a", at(2), None), ("b", at(2), 20.0),
         ("c", at(1), 99.0), ("a", at(3), None)],
        "station_id string, time timestamp_ntz, temp double",
    )
    got = temps(W.interpolate(seen, stations, 42.0, -71.1, k=2), "time")
    assert got[at(1)] == pytest.approx((10 * 4 + 20 * 1) / 5, rel=1e-6)
    assert got[at(2)] == 20.0
    assert got[at(3)] is None
    exact = temps(W.interpolate(seen, stations, 42.0, -71.3, k=3), "time")
    assert exact[at(1)] == 20.0
