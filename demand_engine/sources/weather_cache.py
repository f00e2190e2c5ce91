"""A weather table that fetches only the times it does not hold yet.

Each change writes a complete new folder `v=<n>`; the newest folder with a `_SUCCESS` mark is the
table. Readers of the one before are not disturbed, and a write that dies leaves no mark.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from demand_engine.operators.weather import as_weather, clamped, gaps, merge_weather
from demand_engine.session import cut_lineage
from demand_engine.sources.files import exists, subfolders

# (start, end) -> raw observations in that closed range.
WeatherSource = Callable[[datetime, datetime], DataFrame]


class WeatherCache:
    def __init__(self, spark: SparkSession, path: str, source: WeatherSource) -> None:
        self._spark = spark
        self._path = path.rstrip("/")
        self._source = source

    def _versions(self) -> list[int]:
        numbers = [
            int(name.removeprefix("v=")) for name in subfolders(self._spark, self._path)
            if name.startswith("v=")
        ]
        return sorted(
            n for n in numbers if exists(self._spark, f"{self._path}/v={n}/_SUCCESS")
        )

    def cached(self) -> DataFrame | None:
        """The table as it is, or None before the first fetch."""
        versions = self._versions()
        if not versions:
            return None
        return self._spark.read.parquet(f"{self._path}/v={versions[-1]}")

    def upsert(self, parts: Sequence[DataFrame]) -> DataFrame:
        """Merge new rows into the table, the newest row of a time winning; returns the table."""
        held = self.cached()
        merged = merge_weather([*([] if held is None else [held]), *parts])
        number = max(self._versions(), default=0) + 1
        target = f"{self._path}/v={number}"
        merged.write.mode("overwrite").parquet(target)
        return self._spark.read.parquet(target)

    def _fetch(self, start: datetime, end: datetime) -> DataFrame:
        """Checked observations, kept so that the source is asked once."""
        return as_weather(cut_lineage(self._source(start, end)))

    def weather(self, start: datetime, end: datetime) -> DataFrame:
        """Hourly weather of a closed range. Times outside the cached span are fetched and kept.

        In the result a cached row beats a fetched one before it, and a fetched row after the cached
        span beats a cached one; in the table fetched rows always win.
        """
        held = self.cached()
        if held is None:
            return self.upsert([self._fetch(start, end)])
        fetched = {
            gap["part"]: self._fetch(gap["from_time"], gap["to_time"])
            for gap in gaps(held, start, end).collect()
            if gap["part"] != "cached"
        }
        middle = clamped(held, start, end)
        if not fetched:
            return middle
        self.upsert(list(fetched.values()))
        parts = [fetched.get("head"), middle, fetched.get("tail")]
        return merge_weather([p for p in parts if p is not None])
