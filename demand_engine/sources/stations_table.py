"""The stations table: all published station lists, each tagged with its version."""

from __future__ import annotations

import glob
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from demand_engine.operators.tables import union_relaxed
from demand_engine.schemas import VERSION_DATES
from demand_engine.sources.csv_files import read_station_csv
from demand_engine.sources.files import list_folders, matching


def exact_files(names: Sequence[str], dates: Mapping[int, datetime] = VERSION_DATES) -> dict[int, str]:
    """The lists' files by version, given their exact names in order of version."""
    if len(names) != len(dates):
        raise ValueError(f"{len(dates)} station files are needed, not {len(names)}")
    return {version: glob.escape(name) for version, name in zip(sorted(dates), names)}


def read_snapshots(
    listing: DataFrame, lists: Mapping[int, str], dates: Mapping[int, datetime] = VERSION_DATES
) -> DataFrame:
    """The rows of every list among the files, under the canonical columns.

    `lists` names the file of each version. It is compared as a pattern (`*`, `?`, `[…]`, `[!…]`) with a
    file's base name, or with its path below the folder if it has a slash.
    """
    return union_relaxed(
        [
            read_station_csv(matching(listing, lists[version]), version, dates[version])
            for version in sorted(lists)
        ]
    )


def update_stations(
    spark: SparkSession,
    folders: Sequence[str],
    table: str,
    lists: Mapping[int, str],
    dates: Mapping[int, datetime] = VERSION_DATES,
) -> str:
    rows = read_snapshots(list_folders(spark, folders), lists, dates)
    rows.write.mode("overwrite").parquet(table)
    return table


def read_stations(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.parquet(table)
