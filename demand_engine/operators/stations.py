"""Station names, station attributes and the station list in force at a time."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demand_engine.functions.names import clean_station_name, gender, user_type
from demand_engine.functions.times import ntz
from demand_engine.operators.joins import Size, left_lookup, measure
from demand_engine.operators.tables import quoted
from demand_engine.schemas import VERSION_DATES
from demand_engine.session import cut_lineage

VersionColumn = Callable[[str], Column]

STATION_ATTRIBUTES = ("station_name", "total_docks", "station_version", "public", "district")

# Attribute of a station -> column of the trip that visits it in a role.
_VISITED = {
    "station_name": "{}_station_name",
    "station_version": "{}_station_version",
    "total_docks": "{}_station_total_docks",
    "public": "{}_station_public",
    "district": "{}_district",
}


def station_version(
    time_col: str, dates: Mapping[int, datetime] = VERSION_DATES
) -> Column:
    """The version in force at a time: the last whose first day is not later, else the first one.

    A null time gets the first version. For fixed dates in ascending order; `version_as_of` takes
    a table. The version's place is the number of later first days that the time has reached.
    """
    versions = F.array(*map(F.lit, dates))
    reached = [
        F.coalesce(F.col(time_col) >= ntz(day), F.lit(False)).cast("int")
        for day in list(dates.values())[1:]
    ]
    return versions[sum(reached, F.lit(0))].alias("station_version")


def _spells(validity: DataFrame) -> DataFrame:
    """(day, since, until, station_version): which version holds, cut at midnights; until may be null.

    Days between two entries have the version of the earlier one, so there is at most one row per
    entry and one per calendar day. Only the table of days with entries is ordered as a whole; the
    calendar bounds it.
    """
    entries = (
        validity.where(F.col("effective_from").isNotNull())
        .groupBy("effective_from")
        .agg(F.max("station_version").alias("station_version"))
        .withColumn("day", F.to_date("effective_from"))
    )
    within = Window.partitionBy("day").orderBy("effective_from")
    own = entries.select(
        "day",
        F.col("effective_from").alias("since"),
        F.lead("effective_from").over(within).alias("until"),
        "station_version",
    )
    days = entries.groupBy("day").agg(
        F.min("effective_from").alias("first"),
        F.max_by("station_version", "effective_from").alias("station_version"),
    )
    calendar = Window.orderBy("day")
    days = days.withColumns(
        {"next": F.lead("day").over(calendar), "next_first": F.lead("first").over(calendar)}
    ).where(F.col("next").isNotNull())
    days = days.withColumn("later", F.explode(F.sequence(F.date_add("day", 1), F.col("next"))))
    carried = days.select(
        F.col("later").alias("day"),
        F.col("later").cast("timestamp_ntz").alias("since"),
        F.when(F.col("later") == F.col("next"), F.col("next_first")).alias("until"),
        "station_version",
    )
    return own.unionByName(carried)


def version_as_of(df: DataFrame, time_col: str, validity: DataFrame) -> DataFrame:
    """`station_version` from a table (effective_from, station_version) of any length.

    Each entry holds until the next; the first one holds before its date and for a null time too.
    Lookups are by day and then by the few entries of that day. The day table is broadcast when its
    measured size allows that and joined by a shuffle otherwise.
    """
    spells = cut_lineage(_spells(validity))
    known = validity.where(F.col("effective_from").isNotNull())
    entry = F.struct("effective_from", "station_version")
    ends = known.agg(
        F.max(entry).alias("last"),
        F.min_by("station_version", F.struct("effective_from", -F.col("station_version"))).alias("first"),
    )
    last, first = (ends.select(c).scalar() for c in ("last", "first"))
    table = spells.toDF("__day", "__since", "__until", "__version")
    if measure(table).fits():
        table = F.broadcast(table)
    time = F.col(time_col)
    holds = (time >= F.col("__since")) & (F.col("__until").isNull() | (time < F.col("__until")))
    found = df.join(table, (F.to_date(time) == F.col("__day")) & holds, "left")
    after = F.when(time >= last["effective_from"], last["station_version"])
    return found.withColumn("station_version", F.coalesce("__version", after, first)).select(
        *(quoted(c) for c in df.columns if c != "station_version"), "station_version"
    )


def station_map(stations: DataFrame) -> DataFrame:
    """Each raw station name once, with its clean form."""
    return (
        stations.select("station_name")
        .distinct()
        .withColumn("clean_station_name", clean_station_name(F.col("station_name")))
    )


def map_names(
    df: DataFrame, column: str, names: DataFrame, size: Size | None = None
) -> DataFrame:
    """Replace a name listed in `names` by its clean form; keep any other name as it is."""
    table = names.select(
        F.col("station_name").alias(column), F.col("clean_station_name").alias("__clean")
    )
    columns = df.columns
    return (
        left_lookup(df, table, [column], size)
        .withColumn(column, F.coalesce("__clean", column))
        .select(columns)
    )


def normalize_stations(
    stations: DataFrame, names: DataFrame | None = None, size: Size | None = None
) -> DataFrame:
    """Station attributes under clean names.

    Without `names` each name is cleaned in place, which is what the map of the same stations would
    give, without a join.
    """
    attributes = stations.select(*STATION_ATTRIBUTES)
    if names is None:
        return attributes.withColumn("station_name", clean_station_name(F.col("station_name")))
    return map_names(attributes, "station_name", names, size)


def normalize_trips(
    trips: DataFrame,
    names: DataFrame,
    version: VersionColumn = station_version,
    size: Size | None = None,
) -> DataFrame:
    """Clean the known station names, map rider type and gender, add both station versions.

    A trip name is compared with the raw station names, never cleaned itself.
    """
    added = {
        "start_station_version": version("started_at"),
        "end_station_version": version("ended_at"),
        "user_type": user_type(F.col("user_type")),
    }
    if "gender" in trips.columns:
        added["gender"] = gender(F.col("gender"))
    size = size or measure(names)
    named = map_names(trips.withColumns(added), "start_station_name", names, size)
    return map_names(named, "end_station_name", names, size)


def visited(stations: DataFrame, role: str) -> DataFrame:
    """The station table with the names that its columns have on a trip, for one role."""
    named = {c: _VISITED[c].format(role) for c in stations.columns if c in _VISITED}
    return stations.withColumnsRenamed(named)


def attach_stations(
    trips: DataFrame, stations: DataFrame, size: Size | None = None
) -> DataFrame:
    """Attributes of the start and of the end station, each in the version of its own time.

    Stations that share a clean name and a version repeat the trip, see `duplicate_stations`.
    """
    size = size or measure(stations)

    def attached(rows: DataFrame, role: str) -> DataFrame:
        keys = [_VISITED[c].format(role) for c in ("station_name", "station_version")]
        return left_lookup(rows, visited(stations, role), keys, size)

    return attached(attached(trips, "start"), "end")


def standardize(
    trips: DataFrame,
    stations: DataFrame,
    version: VersionColumn = station_version,
    size: Size | None = None,
) -> DataFrame:
    """Clean names, versions and attributes of both stations on every trip.

    The station table is measured once, with the clean name beside the raw one; neither the name
    map nor the attribute table is larger than that.
    """
    size = size or measure(
        stations.select(*STATION_ATTRIBUTES).withColumn(
            "clean_station_name", clean_station_name(F.col("station_name"))
        )
    )
    names = station_map(stations)
    return normalize_trips(trips, names, version, size).transform(
        attach_stations, normalize_stations(stations), size
    )


def duplicate_stations(stations: DataFrame) -> DataFrame:
    """Clean name and version pairs that occur more than once, with their count."""
    return (
        normalize_stations(stations)
        .groupBy("station_name", "station_version")
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )
