from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from demand_engine.operators import demand as D
from demand_engine.operators import report as R
from demand_engine.operators.modeling import chronological_split
from demand_engine.queries import views
from demand_engine.schemas import FEATURE_COLUMNS, WEATHER_FILLS

TRIPS = (
    "ride_id bigint, started_at timestamp_ntz, start_station_name string, start_lat double, "
    "start_lng double, start_station_total_docks bigint, temp double, rhu double, prcp double, "
    "wspd double, wdir double, snow double"
)
T0 = datetime(2024, 1, 5, 8)


def trip(ride, minutes, station="a", lat=1.0, docks=5, temp=10.0, prcp=None):
    at = T0 + timedelta(minutes=minutes)
    return (ride, at, station, lat, 2.0, docks, temp, 50.0, prcp, 3.0, 4.0, None)


def frame(spark, *rows):
    return spark.createDataFrame(rows, TRIPS).repartition(4)


def test_first_trip_decides_and_nulls_count(spark):
    trips = frame(
        spark, trip(3, 5, lat=9.0, temp=1.0), trip(1, 50, lat=None, temp=7.0), trip(2, 10, lat=4.0)
    )
    (row,) = D.station_hours(trips, "ride_id").collect()
    assert (row["datetime"], row["station"], row["demand"]) == (T0, "a", 3)
    assert row["lat"] is None and row["temp"] == 7.0
    (by_time,) = D.station_hours(trips).collect()
    assert by_time["lat"] == 9.0


def test_counts_add_up_to_the_trips(spark, small):
    trips = views.trips(spark, small)
    hours = D.station_hours(trips, "ride_id", firsts={"start_lat": "lat"})
    assert hours.agg(F.sum("demand")).first()[0] == trips.count()


def test_fills_and_dropping(spark):
    trips = frame(
        spark,
        trip(1, 0, temp=10.0),
        trip(2, 60, temp=20.0, prcp=1.5),
        trip(3, 120, temp=None),
        trip(4, 180, lat=None, temp=60.0),
        trip(5, 240, station=None, temp=None),
    )
    rows = D.demand_features(trips, "ride_id").collect()
    assert [r["temp"] for r in rows] == [10.0, 20.0, 30.0]  # the dropped row counts in the mean
    assert [r["prcp"] for r in rows] == [0.0, 1.5, 0.0]
    assert all(r["is_weekend"] for r in rows)
    assert set(FEATURE_COLUMNS) <= set(rows[0].asDict())
    assert [r["hour"] for r in rows] == [8, 9, 10]


def test_nan_is_a_value(spark):
    df = spark.createDataFrame([(float("nan"), 1.0), (None, None)], "prcp double, temp double")
    rows = D.fill_missing(df, {"prcp": 0.0, "temp": "mean"}).collect()
    assert str(rows[0]["prcp"]) == "nan" and rows[1]["prcp"] == 0.0 and rows[1]["temp"] == 1.0


def test_fitted_fills_apply_to_other_rows(spark):
    seen = spark.createDataFrame([(10.0, None), (20.0, 1.0)], "temp double, prcp double")
    fills = D.fitted_fills(seen, {"temp": "mean", "prcp": 0.0})
    assert fills == {"temp": 15.0, "prcp": 0.0}
    other = spark.createDataFrame([(None, None)], "temp double, prcp double")
    assert tuple(D.fill_missing(other, fills).first()) == (15.0, 0.0)


def nodes(plan):
    """All operators of an executed plan, those of subqueries included, shared ones once."""
    yield plan
    if plan.nodeName() in ("ReusedExchange", "ReusedSubquery"):
        return
    for part in (plan.children(), plan.subqueries()):
        for i in range(part.size()):
            yield from nodes(part.apply(i))


QUERIES_WITH_MEANS = {
    "features": lambda s, d: D.demand_features(views.enriched(s, d), "ride_id", ordered=False),
    "summary": lambda s, d: R.hour_summary(january_report(s, d)),
    "map": lambda s, d: R.map_columns(january_report(s, d)),
    "split": lambda s, d: chronological_split(
        D.demand_features(views.enriched(s, d), "ride_id", ordered=False), datetime(2024, 1, 31), 1
    ),
}


def january_report(spark, sf_dir):
    days = datetime(2024, 1, 1), datetime(2024, 1, 31)
    return R.prediction_report(views.enriched(spark, sf_dir), score, *days, "ride_id", False)


@pytest.mark.parametrize("name", list(QUERIES_WITH_MEANS))
def test_trips_are_shuffled_once_after_partial_aggregation(spark, small, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = QUERIES_WITH_MEANS[name](spark, small)
        plan = list(nodes(df._jdf.queryExecution().executedPlan()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    kinds = [p.nodeName() for p in plan]
    by_station = [
        p for p in plan
        if p.nodeName() == "Exchange" and "start_station_name" in p.outputPartitioning().toString()
    ]
    assert len(by_station) == 1
    assert "partial_min_by(start_lat" in by_station[0].toString()
    assert not {"SortAggregate", "ObjectHashAggregate", "CartesianProduct"} & set(kinds)
    assert not any("NestedLoop" in k for k in kinds)


def score(features):
    return features.withColumn("prediction", F.col("actual") - 1.5)


def test_report_of_a_range(spark):
    trips = frame(spark, trip(1, 0), trip(2, 1), trip(3, 2), trip(4, 60), trip(5, 600))
    report = R.prediction_report(trips, score, T0, T0 + timedelta(hours=1), "ride_id")
    rows = report.collect()
    assert [(r["actual"], r["predicted"], r["error"]) for r in rows] == [(3, 2, 1), (1, 0, 1)]
    empty = R.prediction_report(trips, score, datetime(2020, 1, 1), datetime(2020, 1, 2))
    assert empty.count() == 0 and empty.columns == report.columns
    assert dict(empty.dtypes)["predicted"] == "bigint"


def test_axis_summary_and_text(spark):
    report = spark.createDataFrame(
        [(T0, "b-side st", 1.0, 2.0, 1200, 1100, 100), (T0, "a", 1.0, 2.0, 3, 53, -50),
         (T0 + timedelta(hours=3), "a", 1.0, 2.0, 1, 1, 0)],
        "datetime timestamp_ntz, station string, lat double, lng double, actual bigint, "
        "predicted bigint, error bigint",
    )
    assert [r[0] for r in R.hour_axis(report).orderBy("datetime").collect()] == [
        T0 + timedelta(hours=h) for h in range(4)
    ]
    assert R.hour_axis(report.where("actual < 0")).count() == 0
    text = R.summary_text(R.hour_summary(report)).orderBy("datetime").first()
    assert tuple(text)[1:] == ("2024-01-05 08:00", 2, "1,203", "1,153")
    shown = {(r["station_title"], r["error"]): r for r in R.map_columns(report).collect()}
    assert shown[("B-Side St", 100)]["error_position"] == 1.0
    assert shown[("A", -50)]["error_position"] == 0.25
    assert shown[("A", 0)]["error_position"] == 0.5
    assert shown[("A", 0)]["elevation_scale"] == 100


@pytest.mark.parametrize("column", list(WEATHER_FILLS))
def test_every_filled_column_is_a_feature(column):
    assert column in FEATURE_COLUMNS
