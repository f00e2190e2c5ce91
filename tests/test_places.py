"""Nearest places against all distances: anywhere on the globe, ties, repeated and missing places."""

import math
import random
from datetime import datetime

import pytest

from demand_engine.operators.places import interpolate_each, interpolated_source, nearest_to_each
from demand_engine.operators.weather import interpolate

STATIONS = "station_id string, lat double, lng double"
TARGETS = "target_id int, lat double, lng double"


def km(a, b):
    (p, q), (r, s) = ([math.radians(v) for v in x] for x in (a, b))
    chord = math.sin((p - r) / 2) ** 2 + math.cos(p) * math.cos(r) * math.sin((q - s) / 2) ** 2
    return 2 * 6371.0088 * math.asin(math.sqrt(min(1.0, chord)))


def brute(targets, stations, k):
    out = {}
    for t, *at in targets:
        if None not in at:
            near = sorted((round(km(at, place), 6), s) for s, *place in stations if None not in place)
            out[t] = [d for d, _ in near[:k]]
    return out


def found(spark, targets, stations, k, **more):
    rows = nearest_to_each(spark.createDataFrame(targets, TARGETS), spark.createDataFrame(stations, STATIONS), k, **more).collect()
    out = {}
    for r in sorted(rows, key=lambda r: r.place):
        out.setdefault(r.target_id, []).append(round(r.distance_km, 6))
    assert len({(r.target_id, r.station_id) for r in rows}) == len(rows)
    return out


def globe(rng):
    return rng.choice([
        (rng.uniform(-90, 90), rng.uniform(-180, 180)), (rng.uniform(89.5, 90), rng.uniform(-180, 180)), (-90.0, 0.0),
        (rng.uniform(-1, 1), rng.choice([-180, 180, 179.999, -179.99])), (42.36 + rng.uniform(-0.1, 0.1), -71.06 + rng.uniform(-0.1, 0.1)),
    ])


@pytest.mark.parametrize("seed, finest", [(1, 12), (2, 3)])
def test_nearest_places_anywhere(spark, seed, finest):
    rng = random.Random(seed)
    stations = [(f"s{k:03d}", *map(float, globe(rng))) for k in range(150)]
    targets = [(k, *map(float, globe(rng))) for k in range(120)]
    targets += [(500, stations[0][1], stations[0][2]), (501, None, 1.0), (502, 1.0, None), (120, *targets[0][1:])]
    want = brute(targets, stations, 4)
    got = found(spark, targets, stations, 4, finest=finest)
    assert got.keys() == want.keys()
    for t in want:
        assert got[t] == pytest.approx(want[t], abs=1e-4)


def test_ties_repeats_and_few_stations(spark):
    stations = [(f"s{k:03d}", 10.0, 20.0) for k in range(300)] + [("t", 10.0, 20.001), ("u", None, 20.0)]
    rows = nearest_to_each(spark.createDataFrame([(1, 10.0, 20.0), (2, 10.0, 20.0)], TARGETS), spark.createDataFrame(stations, STATIONS), 3)
    assert sorted((r.target_id, r.place, r.station_id) for r in rows.collect()) == [(t, k + 1, f"s{k:03d}") for t in (1, 2) for k in range(3)]
    assert found(spark, [(1, 0.0, 0.0)], stations[-2:], 4) == {1: [pytest.approx(km((0, 0), (10, 20.001)), abs=1e-4)]}
    none = spark.createDataFrame([], STATIONS)
    assert nearest_to_each(spark.createDataFrame([(1, 0.0, 0.0)], TARGETS), none).count() == 0
    assert nearest_to_each(spark.createDataFrame([], TARGETS), spark.createDataFrame(stations, STATIONS)).count() == 0


def test_interpolation_at_targets_is_that_at_a_point(spark):
    rng = random.Random(3)
    stations = spark.createDataFrame([(f"s{k}", 42.3 + k / 100, -71.0 - k / 90) for k in range(9)], STATIONS)
    seen = [(f"s{k}", datetime(2024, 1, 1, h), rng.random() if rng.random() < 0.8 else None, rng.random()) for k in range(9) for h in range(12)]
    observations = spark.createDataFrame(seen, "station_id string, time timestamp_ntz, temp double, other double")
    points = [(1, 42.35, -71.03), (2, 42.3, -71.0), (3, 42.36, -71.06)]
    each = interpolate_each(observations, nearest_to_each(spark.createDataFrame(points, TARGETS), stations))
    assert each.columns == ["target_id", "time", "temp"]
    for t, lat, lng in points:
        want = {r.time: r.temp for r in interpolate(observations, stations, lat, lng).collect()}
        got = {r.time: r.temp for r in each.where(f"target_id = {t}").collect()}
        assert got == {h: pytest.approx(v) if v is not None else None for h, v in want.items()}
    source = interpolated_source(observations, stations)
    asked = source(datetime(2024, 1, 1, 3), datetime(2024, 1, 1, 5))
    assert sorted(r.time.hour for r in asked.collect()) == [3, 4, 5]
