"""Numeric columns: predictions, errors, display scales, distances, run parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0088

TUNED_PREFIX = "tuned_"


def whole_trips(prediction: Column) -> Column:
    """A prediction as a trip count: not negative, halves to the even neighbour."""
    at_least_zero = F.when(prediction < 0, F.lit(0.0)).otherwise(prediction)
    return F.bround(at_least_zero).cast("bigint")


def prediction_error(actual: Column, predicted: Column) -> Column:
    return actual - predicted


def symmetric_max(error: Column) -> Column:
    """Aggregate: the largest distance from zero, at least 1."""
    return F.greatest(F.abs(F.min(error)), F.abs(F.max(error)), F.lit(1))


def diverging_position(error: Column, scale: Column) -> Column:
    """Where an error sits on a two-sided scale: 0 at -scale, one half at zero, 1 at +scale."""
    return F.lit(0.5) + error / (F.lit(2.0) * scale)


def elevation_scale(largest: Column) -> Column:
    """Column height multiplier for a map, from the largest value shown."""
    return F.when(largest > 50, 5).when(largest > 10, 30).otherwise(100)


def grouped_digits(c: Column) -> Column:
    return F.format_number(c, 0)


def distance_between(lat: Column, lng: Column, to_lat: Column, to_lng: Column) -> Column:
    """Great-circle distance of two points."""
    dlat = F.radians(lat - to_lat) / 2
    dlng = F.radians(lng - to_lng) / 2
    chord = F.pow(F.sin(dlat), F.lit(2)) + F.cos(F.radians(lat)) * F.cos(
        F.radians(to_lat)
    ) * F.pow(F.sin(dlng), F.lit(2))
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.when(chord > 1, F.lit(1.0)).otherwise(chord)))


def distance_km(lat: Column, lng: Column, to_lat: float, to_lng: float) -> Column:
    """Great-circle distance to a fixed point."""
    return distance_between(lat, lng, F.lit(to_lat), F.lit(to_lng))


def nan_to_null(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def typed_parameter(text: Column, digits_only: bool = False) -> Column:
    """A logged parameter as struct(whole, fraction, text): one of the three is set.

    `digits_only` accepts digits with at most one point and nothing else, so that "1e-05" and "-3"
    stay text; otherwise every number is read as one. "nan" counts as missing.
    """
    shape = r"^(?=.*\d)\d*\.?\d*$" if digits_only else r"^[+-]?(?=\.?\d)\d*\.?\d*([eE][+-]?\d+)?$"
    value = F.when(text.rlike(shape), text.try_cast("double"))
    is_whole = value == F.floor(value)
    return F.struct(
        F.when(is_whole, value.try_cast("bigint")).alias("whole"),
        F.when(~is_whole, value).alias("fraction"),
        F.when(value.isNull() & (F.lower(text) != "nan"), text).alias("text"),
    )


def tuned_name(parameter: Column) -> Column:
    """The parameter behind a logged `tuned_*` name; null for any other name."""
    return F.when(
        parameter.startswith(TUNED_PREFIX), F.substr(parameter, F.lit(len(TUNED_PREFIX) + 1))
    )
