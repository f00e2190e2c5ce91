"""Time columns. Timestamps carry no zone (`timestamp_ntz`) throughout."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from demand_engine.schemas import WEEKEND_DAYS

# Fixed value: how trip files write a time; the fraction may be missing.
TRIP_TIME_PATTERN = "yyyy-MM-dd HH:mm:ss[.SSSSSSSSS]"

# Fixed value: a month in the windows of a training run.
DAYS_PER_MONTH = 30



def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def ntz(value: Column | datetime) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("timestamp_ntz")


def parse_time(c: Column, pattern: str = TRIP_TIME_PATTERN) -> Column:
    """Read a time; text of another shape gives null."""
    return F.try_to_timestamp(c, F.lit(pattern)).cast("timestamp_ntz")


def hour_number(c: Column) -> Column:
    """Full hours since 1970 as a number, the cheapest key to group and join hours by.

    For zone-free times `unix_timestamp` is plain arithmetic, independent of the session's zone,
    while `date_trunc` converts to zoned time and back for each row. It cuts towards zero, so times
    before 1970 are set right separately.
    """
    seconds = F.unix_timestamp(c)
    cut = (c < _epoch() + F.make_dt_interval(secs=seconds)).cast("int")
    early = F.floor((seconds - cut) / F.lit(3600))
    return F.when(c >= _epoch(), F.call_function("div", seconds, F.lit(3600))).otherwise(early)


def hour_time(number: Column) -> Column:
    """The time a numbered hour starts."""
    return _epoch() + F.make_dt_interval(hours=number.cast("int"))


def hour_of(c: Column) -> Column:
    """The full hour a time lies in."""
    return hour_time(hour_number(c))


def iso_weekday(c: Column) -> Column:
    return F.weekday(c) + F.lit(1)


def is_weekend(c: Column, days: Sequence[int] = WEEKEND_DAYS) -> Column:
    return iso_weekday(c).isin(*days)


def calendar(c: Column, weekend_days: Sequence[int] = WEEKEND_DAYS) -> dict[str, Column]:
    """The calendar features of a time, by column name."""
    return {
        "hour": F.hour(c),
        "weekday": iso_weekday(c),
        "month": F.month(c),
        "year": F.year(c),
        "is_weekend": is_weekend(c, weekend_days),
    }


def hour_label(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:00")


def previous_month(as_of: Column) -> dict[str, Column]:
    """First and last day of the month before `as_of`."""
    first = F.add_months(F.trunc(as_of, "MM"), -1)
    return {"first_day": first, "last_day": F.last_day(first)}


def day_bounds(first_day: Column, last_day: Column) -> dict[str, Column]:
    """The closed time range of whole days; its end is the last full second."""
    return {
        "range_start": ntz(first_day),
        "range_end": ntz(F.date_add(last_day, 1)) - F.expr("INTERVAL 1 SECOND"),
    }


def days_before(c: Column, days: int) -> Column:
    return c - F.expr(f"INTERVAL {int(days)} DAYS")
