from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from demand_engine.functions import measures, times


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (_, t) in values.items())
    row = spark.createDataFrame([tuple(v for v, _ in values.values())], schema)
    return row.select(column.alias("out")).first()["out"]


@pytest.mark.parametrize(
    ("text", "time"),
    [
        ("2017-01-01 00:05:01", datetime(2017, 1, 1, 0, 5, 1)),
        ("2017-01-01 00:05:01.5", datetime(2017, 1, 1, 0, 5, 1, 500000)),
        ("2017-01-01 00:05:01.1230", datetime(2017, 1, 1, 0, 5, 1, 123000)),
        ("1/1/2017 0:05", None),
        ("2017-1-1 00:05:01", None),
        ("2017-01-01 00:05", None),
        ("", None),
        (None, None),
    ],
)
def test_lenient_times(spark, text, time):
    assert one(spark, times.parse_time(F.col("t")), t=(text, "string")) == time


HOURS = [
    datetime(1970, 1, 1),
    datetime(1970, 1, 1, 0, 59, 59, 999999),
    datetime(1969, 12, 31, 23, 59, 59, 500000),
    datetime(1969, 12, 31, 23),
    datetime(1969, 12, 31, 22, 59, 59, 999999),
    datetime(1960, 2, 29, 5, 30),
    datetime(2024, 3, 10, 2, 30),
    datetime(2024, 11, 3, 1, 59, 59, 999999),
    None,
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_hours_in_any_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in HOURS], "t timestamp_ntz").repartition(2)
        rows = df.select("t", times.hour_number(F.col("t")).alias("n"), times.hour_of(F.col("t")).alias("h"))
        got = {r["t"]: (r["n"], r["h"]) for r in rows.collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got.pop(None) == (None, None)
    for t, (number, hour) in got.items():
        assert number == (t - datetime(1970, 1, 1)) // timedelta(hours=1)
        assert hour == t.replace(minute=0, second=0, microsecond=0)


def test_weekend_is_friday_and_saturday_by_default(spark):
    week = [datetime(2024, 1, d) for d in range(1, 8)]
    df = spark.createDataFrame([(d,) for d in week], "t timestamp_ntz").orderBy("t")
    got = df.select(times.iso_weekday(F.col("t")), times.is_weekend(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [
        (1, False), (2, False), (3, False), (4, False), (5, True), (6, True), (7, False),
    ]
    usual = df.select(times.is_weekend(F.col("t"), (6, 7)).alias("w")).collect()
    assert [r["w"] for r in usual] == [False] * 5 + [True] * 2


def test_month_before_and_its_bounds(spark):
    days = times.previous_month(F.col("d"))
    assert one(spark, days["first_day"], d=(date(2024, 3, 31), "date")) == date(2024, 2, 1)
    assert one(spark, days["last_day"], d=(date(2024, 1, 1), "date")) == date(2023, 12, 31)
    bounds = times.day_bounds(days["first_day"], days["last_day"])
    assert one(spark, bounds["range_end"], d=(date(2024, 3, 5), "date")) == datetime(
        2024, 2, 29, 23, 59, 59
    )


@pytest.mark.parametrize(
    ("prediction", "trips"), [(2.5, 2), (3.5, 4), (0.5, 0), (-4.0, 0), (2.51, 3), (None, None)]
)
def test_whole_trips(spark, prediction, trips):
    assert one(spark, measures.whole_trips(F.col("p")), p=(prediction, "double")) == trips


@pytest.mark.parametrize(("largest", "scale"), [(51, 5), (50, 30), (11, 30), (10, 100), (1, 100)])
def test_elevation(spark, largest, scale):
    assert one(spark, measures.elevation_scale(F.col("n")), n=(largest, "int")) == scale


def test_error_scale_is_symmetric_and_at_least_one(spark):
    df = spark.createDataFrame([(1, -7), (1, 3), (2, 0)], "g int, e bigint")
    got = df.groupBy("g").agg(measures.symmetric_max(F.col("e")).alias("m")).orderBy("g").collect()
    assert [r["m"] for r in got] == [7, 1]
    at = measures.diverging_position(F.col("e"), F.lit(7))
    assert [one(spark, at, e=(e, "bigint")) for e in (-7, 0, 7)] == [0.0, 0.5, 1.0]


@pytest.mark.parametrize(
    ("text", "default", "digits_only"),
    [
        ("5", 5, 5),
        ("200.0", 200, 200),
        ("0.05", 0.05, 0.05),
        (".5", 0.5, 0.5),
        ("1e-05", 1e-05, "1e-05"),
        ("-3", -3, "-3"),
        ("1.2.3", "1.2.3", "1.2.3"),
        (".", ".", "."),
        ("gbdt", "gbdt", "gbdt"),
        ("nan", None, None),
        (None, None, None),
    ],
)
def test_parameters(spark, text, default, digits_only):
    for strict, expected in ((False, default), (True, digits_only)):
        got = one(spark, measures.typed_parameter(F.col("t"), strict), t=(text, "string"))
        assert next((v for v in got if v is not None), None) == expected
        assert sum(v is not None for v in got) == (expected is not None)


def test_distance_to_itself_and_a_known_pair(spark):
    at = measures.distance_km(F.col("a"), F.col("b"), 42.36, -71.06)
    assert one(spark, at, a=(42.36, "double"), b=(-71.06, "double")) == 0.0
    new_york = one(spark, at, a=(40.7128, "double"), b=(-74.0060, "double"))
    assert new_york == pytest.approx(306, abs=2)
