from datetime import datetime

import pytest
from pyspark.sql import functions as F

from demand_engine.operators import quality as Q
from demand_engine.operators import tables as T
from demand_engine.schemas import TRIP_RULES, WEATHER_RULES


def test_rename_is_exact_and_lenient(spark):
    df = spark.createDataFrame([(1, 2)], "Name int, other int")
    assert T.rename_known(df, {"name": "a", "Name": "b", "absent": "c"}).columns == ["b", "other"]
    with pytest.raises(ValueError, match="share a name"):
        T.rename_known(df, {"Name": "other"})
    with pytest.raises(ValueError, match="no such column"):
        T.rename_required(df, {"name": "a"})


def test_rename_keeps_odd_names(spark):
    df = spark.createDataFrame([(1, 2)], "`# of Docks` int, `a.b` int")
    got = T.rename_known(df, {"# of Docks": "total_docks"})
    assert got.columns == ["total_docks", "a.b"]
    assert tuple(got.first()) == (1, 2)


def test_relaxed_union_widens(spark):
    a = spark.createDataFrame([(1, 1, "x")], "n bigint, m int, only_a string")
    b = spark.createDataFrame([("021XX", 2.5)], "n string, m double")
    got = T.union_relaxed([a, b])
    assert dict(got.dtypes) == {"n": "string", "m": "double", "only_a": "string"}
    assert sorted(map(tuple, got.collect())) == [("021XX", 2.5, None), ("1", 1.0, "x")]


def test_relaxed_union_keeps_duplicates(spark):
    a = spark.createDataFrame([(1,), (1,)], "n int")
    assert T.union_relaxed([a, a, a]).count() == 6


def test_null_filter_keeps_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "v double")
    assert T.without_nulls(df).count() == 2


def test_last_row_per_key_keeps_nulls_and_one_null_key(spark):
    df = spark.createDataFrame(
        [("a", 1, 5.0), ("a", 2, None), (None, 1, 1.0), (None, 3, 2.0)], "k string, r int, v double"
    )
    got = {r["k"]: r["v"] for r in T.latest_per_key(df, ["k"], "r").collect()}
    assert got == {"a": None, None: 2.0}
    both = T.latest_per_key(df, ["k"], ["r", "v"])
    assert sorted(map(str, both.collect())) == sorted(map(str, T.latest_per_key(df, ["k"], "r").collect()))


def test_range_is_closed_and_pushed_down(spark, small):
    days = datetime(2024, 1, 1), datetime(2024, 1, 2)
    df = spark.createDataFrame([(d,) for d in days], "started_at timestamp_ntz")
    assert T.between(df, "started_at", *days).count() == 2
    events = spark.read.parquet(f"{small}/events.parquet")
    plan = T.between(events, "ts", *days)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThanOrEqual(ts" in plan


def test_canonical_casts_and_keeps_extras(spark):
    df = spark.createDataFrame([("7", "x", "e")], "a string, b string, extra string")
    got = T.canonical(df, {"b": "bigint", "a": "bigint", "c": "double"})
    assert got.columns == ["b", "a", "c", "extra"]
    assert tuple(got.first()) == (None, 7, None, "e")


def test_violations_of_declared_trips(spark):
    df = spark.createDataFrame(
        [(None, datetime(2024, 1, 1), 5)], "started_at timestamp_ntz, ended_at timestamp_ntz, start_station_id int"
    )
    found = {(r["column"], r["check"]): r["failures"] for r in Q.violations(df, TRIP_RULES).collect()}
    assert found[("started_at", "null")] == 1
    assert found[("start_station_id", "type")] == 1
    assert found[("gender", "missing")] == 1
    assert ("ended_at", "null") not in found
    with pytest.raises(Q.SchemaViolation, match="started_at"):
        Q.validate(df, TRIP_RULES)


def test_weather_is_coerced_and_completed(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), "1.5", 3)], "time timestamp_ntz, temp string, coco int")
    got = Q.validate(df, WEATHER_RULES)
    assert got.columns[0] == "time" and len(got.columns) == 12
    assert got.first()["temp"] == 1.5 and got.first()["snow"] is None
    bad = df.withColumn("temp", F.lit("warm"))
    with pytest.raises(Q.SchemaViolation, match="temp: unreadable"):
        Q.validate(bad, WEATHER_RULES)
