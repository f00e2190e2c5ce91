"""Standardised trips by start date, of which single dates are replaced while others are read.

Layout: `<table>/data/started_date=<date>/version=<label>/…` holds one date's rows as some run wrote them,
`<table>/state/<number>.json` says which label counts for each date and what the rows were made from. A run
writes new folders first and its state last, under a new name: readers see all of a run or nothing of it, and
a run that dies leaves folders that no state names. Folders are deleted when none of the last states names them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demand_engine.operators.tables import DATE_PARTITION
from demand_engine.sources.csv_files import SOURCE_FILE
from demand_engine.sources.files import exists, list_objects, read_text, remove, rename, write_text

#: States, and with them the dates they name, that stay readable.
KEPT_STATES = 2
VERSION = "version"
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


@dataclass
class State:
    """What counts: per date the label of its rows; and what they were made from: per file of trips its time
    and dates, per date a hash of its weather, a hash of the station lists."""

    number: int = 0
    schema: str = ""
    dates: dict[str, str] = field(default_factory=dict)
    files: dict[str, dict] = field(default_factory=dict)
    weather: dict[str, int] = field(default_factory=dict)
    stations: str = ""


def _numbers(spark: SparkSession, table: str) -> list[int]:
    if not exists(spark, f"{table}/state"):
        return []
    names = [r["name"] for r in list_objects(spark, f"{table}/state").select("name").collect()]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def _state(spark: SparkSession, table: str, number: int) -> State:
    return State(**json.loads(read_text(spark, f"{table}/state/{number:08d}.json")))


def current_state(spark: SparkSession, table: str) -> State | None:
    numbers = _numbers(spark, table)
    return _state(spark, table, numbers[-1]) if numbers else None


def date_text(date: Column) -> Column:
    return F.coalesce(date.cast("string"), F.lit(NO_DATE))


def read_dated(spark: SparkSession, table: str, state: State | None = None) -> DataFrame:
    """The rows of a state, by default the last one, with `started_date`."""
    state = state or current_state(spark, table)
    if state is None:
        raise FileNotFoundError(f"no trips at {table}")
    schema = T.StructType.fromJson(json.loads(state.schema))
    if not state.dates:
        return spark.createDataFrame([], schema)
    paths = [f"{table}/data/{DATE_PARTITION}={date}/{VERSION}={label}" for date, label in sorted(state.dates.items())]
    known = T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())])
    return spark.read.schema(known).option("basePath", f"{table}/data").parquet(*paths).drop(VERSION)


def replace_dates(
    rows: DataFrame,
    table: str,
    touched: Collection[str] | None,
    files: dict[str, int | None],
    weather: dict[str, int],
    stations: str,
) -> State:
    """Write the rows of the touched dates (None: of all) and the state that makes them count.

    `rows` holds all rows of those dates, from any file; dates that get none are gone. Which files and
    dates they are is observed as they are written.
    """
    spark = rows.sparkSession
    before = current_state(spark, table) or State()
    label = uuid.uuid4().hex[:12]
    seen = Observation()
    dated = rows.withColumn(DATE_PARTITION, F.to_date("started_at"))
    parts = F.collect_set(F.struct(F.col(SOURCE_FILE).alias("file"), date_text(F.col(DATE_PARTITION)).alias("date")))
    observed = dated.observe(seen, parts.alias("parts")).withColumn(VERSION, F.lit(label))
    observed.hint("rebalance", DATE_PARTITION).write.mode("append").partitionBy(DATE_PARTITION, VERSION).parquet(f"{table}/data")

    written: dict[str, list[str]] = {}
    for part in seen.get["parts"]:
        written.setdefault(part["file"], []).append(part["date"])
    old = {} if touched is None else {d: v for d, v in before.dates.items() if d not in touched}
    dates = old | {d: label for own in written.values() for d in own}
    made_of = {}
    for name, time in files.items():
        known = before.files.get(name)
        same = touched is not None and known is not None and known["mtime"] == time
        made_of[name] = known if same else {"mtime": time, "dates": sorted(written.get(name, []))}
    fields = [f for f in dated.schema.fields if f.name != DATE_PARTITION]
    schema = T.StructType([*fields, T.StructField(DATE_PARTITION, T.DateType())])
    state = State(before.number + 1, schema.json(), dates, made_of, weather, stations)
    hidden = f"{table}/state/.{label}"
    write_text(spark, hidden, json.dumps(asdict(state)))
    rename(spark, hidden, f"{table}/state/{state.number:08d}.json")
    _retire(spark, table)
    return state


def _retire(spark: SparkSession, table: str) -> None:
    """Delete all but the last states, and the folders that only deleted ones name."""
    numbers = _numbers(spark, table)
    kept, old = numbers[-KEPT_STATES:], numbers[:-KEPT_STATES]
    named = {part for n in kept for part in _state(spark, table, n).dates.items()}
    for n in old:
        for date, label in _state(spark, table, n).dates.items():
            if (date, label) not in named:
                remove(spark, f"{table}/data/{DATE_PARTITION}={date}/{VERSION}={label}")
        remove(spark, f"{table}/state/{n:08d}.json")
