import bisect
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from demand_engine.operators import stations as S

STATIONS = (
    "station_name string, total_docks bigint, station_version bigint, public boolean, district string"
)
TRIPS = (
    "started_at timestamp_ntz, ended_at timestamp_ntz, start_station_name string, "
    "end_station_name string, user_type string, gender string"
)
NOON, LATER = datetime(2024, 1, 1, 12), datetime(2024, 1, 1, 12, 30)


def zero(_column):
    return F.lit(0).cast("bigint").alias("station_version")


def names_of(spark, *names):
    return S.station_map(spark.createDataFrame([(n,) for n in names], "station_name string"))


def test_map_of_names(spark):
    rows = names_of(spark, "Mass Ave At Boylston St", "Central Square", "Central Square").collect()
    assert {r["station_name"]: r["clean_station_name"] for r in rows} == {
        "Mass Ave At Boylston St": "boylston st at mass ave",
        "Central Square": "central sq",
    }
    assert len(rows) == 2


def test_normalized_stations_have_five_columns(spark):
    stations = spark.createDataFrame(
        [("A", 10, 0, True, "Boston", "ignored")], STATIONS + ", extra_col string"
    )
    mapping = spark.createDataFrame(
        [("A", "a_clean")], "station_name string, clean_station_name string"
    )
    got = S.normalize_stations(stations, mapping)
    assert set(got.columns) == {
        "station_name", "total_docks", "station_version", "public", "district",
    }
    assert got.first()["station_name"] == "a_clean"
    assert got.first()["total_docks"] == 10
    assert S.normalize_stations(stations).first()["station_name"] == "a"


def test_trip_names_are_mapped_not_cleaned(spark):
    trips = spark.createDataFrame(
        [
            (NOON, LATER, "Mass Ave At Boylston St", "Central Square", "subscriber", "1"),
            (NOON, LATER, "Unknown Square", None, "Subscriber", "7"),
        ],
        TRIPS,
    )
    mapping = names_of(spark, "Mass Ave At Boylston St", "Central Square")
    got = S.normalize_trips(trips, mapping, zero).orderBy("user_type").collect()
    assert got[1]["start_station_name"] == "boylston st at mass ave"
    assert got[1]["end_station_name"] == "central sq"
    assert (got[1]["user_type"], got[1]["gender"]) == ("member", "male")
    assert got[0]["start_station_name"] == "Unknown Square"
    assert got[0]["end_station_name"] is None
    assert (got[0]["user_type"], got[0]["gender"]) == ("Subscriber", "7")


def test_gender_is_optional_and_versions_are_added(spark):
    trips = spark.createDataFrame(
        [(NOON, datetime(2025, 6, 15), "X", "Y", "member", "0")], TRIPS
    ).drop("gender")
    got = S.normalize_trips(trips, names_of(spark, "X"), lambda c: F.year(c)).first()
    assert "gender" not in got.asDict()
    assert (got["start_station_version"], got["end_station_version"]) == (2024, 2025)


def versioned(spark, *rows):
    return spark.createDataFrame(
        rows,
        "started_at timestamp_ntz, ended_at timestamp_ntz, start_station_name string, "
        "end_station_name string, start_station_version bigint, end_station_version bigint",
    )


def test_trips_without_a_station_stay(spark):
    trips = versioned(spark, (NOON, LATER, "a", "missing", 0, 0), (NOON, LATER, None, "a", 0, 0))
    stations = spark.createDataFrame([("a", 10, 0, True, "Boston")], STATIONS)
    rows = S.attach_stations(trips, stations).orderBy("start_station_name").collect()
    assert len(rows) == 2
    assert rows[0]["start_station_total_docks"] is None
    assert rows[1]["start_station_total_docks"] == 10
    assert rows[1]["end_station_total_docks"] is None


def test_both_roles_and_versions(spark):
    trips = versioned(spark, (NOON, LATER, "a", "b", 0, 0), (LATER, LATER, "a", "a", 0, 1))
    stations = spark.createDataFrame(
        [("a", 10, 0, True, "Boston"), ("b", 20, 0, False, "Cambridge"), ("a", 30, 1, True, "Boston")],
        STATIONS,
    )
    rows = S.attach_stations(trips, stations).orderBy("started_at").collect()
    assert (rows[0]["start_station_total_docks"], rows[0]["end_station_total_docks"]) == (10, 20)
    assert (rows[0]["start_district"], rows[0]["end_district"]) == ("Boston", "Cambridge")
    assert (rows[1]["start_station_total_docks"], rows[1]["end_station_total_docks"]) == (10, 30)


def test_whole_chain(spark):
    stations = spark.createDataFrame(
        [
            ("Mass Ave At Boylston St", 15, 0, True, "Boston"),
            ("Central Square", 20, 0, False, "Cambridge"),
        ],
        STATIONS,
    )
    trips = spark.createDataFrame(
        [
            (NOON, LATER, "Mass Ave At Boylston St", "Central Square", "subscriber", "1"),
            (LATER, LATER, "Unknown Station", "Central Square", "casual", "2"),
        ],
        TRIPS,
    )
    rows = S.standardize(trips, stations, zero).orderBy("started_at").collect()
    assert len(rows) == 2
    first, second = rows
    assert first["start_station_name"] == "boylston st at mass ave"
    assert first["end_station_name"] == "central sq"
    assert (first["user_type"], first["gender"]) == ("member", "male")
    assert (first["start_station_total_docks"], first["end_station_total_docks"]) == (15, 20)
    assert second["start_station_total_docks"] is None
    assert second["end_station_total_docks"] == 20


def test_two_spellings_of_one_station_repeat_the_trip(spark):
    stations = spark.createDataFrame(
        [("Main Street", 10, 0, True, "x"), ("Main St.", 11, 0, True, "x")], STATIONS
    )
    trips = spark.createDataFrame([(NOON, LATER, "Main Street", "z", "casual", "0")], TRIPS)
    rows = S.standardize(trips, stations, zero).collect()
    assert sorted(r["start_station_total_docks"] for r in rows) == [10, 11]
    duplicates = S.duplicate_stations(stations).collect()
    assert [tuple(r) for r in duplicates] == [("main st", 0, 2)]


DATES = {
    datetime(2011, 7, 28): 0,
    datetime(2016, 12, 31): 0,
    datetime(2017, 7, 1): 1,
    datetime(2019, 10, 29): 1,
    datetime(2019, 10, 30): 2,
    datetime(2025, 6, 1): 2,
    datetime(2005, 1, 1): 0,
    None: 0,
}


@pytest.mark.parametrize("as_table", [False, True])
def test_versions(spark, as_table):
    df = spark.createDataFrame([(d,) for d in DATES], "started_at timestamp_ntz")
    if as_table:
        validity = spark.createDataFrame(
            [(day, version) for version, day in S.VERSION_DATES.items()],
            "effective_from timestamp_ntz, station_version int",
        )
        got = S.version_as_of(df, "started_at", validity)
    else:
        got = df.select("started_at", S.station_version("started_at"))
    assert {r["started_at"]: r["station_version"] for r in got.collect()} == DATES


def test_validity_tables_have_no_limit(spark):
    """Twelve thousand dates half a day apart, gaps, ties, a null, and times on every edge."""
    entries = [(datetime(2000, 1, 1) + timedelta(hours=12 * k), k) for k in range(12_000) if k % 50 < 45]
    validity = spark.createDataFrame(
        [*entries, (entries[7][0], 3), (None, 5)], "effective_from timestamp_ntz, station_version int"
    )
    start = datetime(1999, 12, 25)
    times = [start + timedelta(hours=7 * k, minutes=k % 3) for k in range(25_000)] + [d for d, _ in entries[:500]]
    df = spark.createDataFrame([(t,) for t in [*times, None]], "t timestamp_ntz")
    firsts = [d for d, _ in entries]
    got = S.version_as_of(df, "t", validity).collect()
    assert len(got) == len(times) + 1
    for r in got:
        place = 0 if r["t"] is None else max(bisect.bisect_right(firsts, r["t"]) - 1, 0)
        assert r["station_version"] == entries[place][1]
