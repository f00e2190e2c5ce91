"""The trips table, kept up to date with a folder of CSV files.

Layout: `<table>/data/source_file=<name>/…` holds the rows of one file, `<table>/manifest` the
file times of the last complete update, `<table>/schema.json` all columns seen so far.

An update writes rows first and the manifest last. A run that dies in between is simply repeated:
the rows of a file replace the folder of that file, so nothing is loaded twice.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demand_engine.session import cut_lineage
from demand_engine.sources.csv_files import SOURCE_FILE, read_trip_csv
from demand_engine.sources.files import (
    decoded_path,
    exists,
    list_folders,
    list_objects,
    qualified,
    read_text,
    remove,
    subfolders,
    trip_files,
    write_text,
)

MANIFEST_SCHEMA = "name string, mtime bigint"


def load_manifest(spark: SparkSession, table: str) -> DataFrame:
    """(name, mtime) of the files loaded before; empty where there is no manifest."""
    path = f"{table}/manifest"
    if not exists(spark, path):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).json(path)


def save_manifest(listing: DataFrame, table: str) -> None:
    listing.select("name", "mtime").write.mode("overwrite").json(f"{table}/manifest")


def classify(listing: DataFrame, manifest: DataFrame) -> DataFrame:
    """The listing with `status`: `new`, `changed` (another whole-second time) or `unchanged`.

    Files that only the manifest knows are left out.
    """
    recorded = manifest.select("name", F.col("mtime").alias("recorded"))
    status = (
        F.when(F.col("recorded").isNull(), "new")
        .when(F.col("recorded") != F.col("mtime"), "changed")
        .otherwise("unchanged")
    )
    return listing.join(recorded, "name", "left").withColumn("status", status).drop("recorded")


def needs_rebuild(classified: DataFrame) -> DataFrame:
    """One row: files to load, and whether loaded ones have changed."""
    return classified.agg(
        F.count_if(F.col("status") != "unchanged").alias("to_load"),
        F.coalesce(F.bool_or(F.col("status") == "changed"), F.lit(False)).alias("rebuild"),
    )


def _stored(spark: SparkSession, table: str) -> dict[str, str]:
    """Source file -> folder of its rows."""
    folders = [f for f in subfolders(spark, f"{table}/data") if f.startswith(f"{SOURCE_FILE}=")]
    return {unquote(f.partition("=")[2]): f"{table}/data/{f}" for f in folders}


def _data_files(spark: SparkSession, table: str) -> DataFrame:
    """(name, source_file) of the files that hold the table's rows, in one listing."""
    path = f"{table}/data"
    if not exists(spark, path):
        return spark.createDataFrame([], "name string, source_file string")
    folder = F.split("name", "/")[0]
    return list_objects(spark, path).select("name", decoded_path(F.split(folder, "=", 2)[1]).alias(SOURCE_FILE))


def loaded_files(spark: SparkSession, table: str) -> dict[str, int | None]:
    """Files with rows in the table, and the whole-second time that each was loaded with (None: not recorded)."""
    times = {r["name"]: r["mtime"] for r in load_manifest(spark, table).collect()}
    return {name: times.get(name) for name in _stored(spark, table)}


def _write(spark: SparkSession, rows: DataFrame, table: str) -> None:
    """Replace the folders of the files in `rows`, and widen the recorded schema by their columns."""
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(SOURCE_FILE)
        .parquet(f"{table}/data")
    )
    known = _schema(spark, table)
    fields = list(known.fields) if known else []
    names = {f.name for f in fields}
    fields += [f for f in rows.schema.fields if f.name not in names]
    ordered = [f for f in fields if f.name != SOURCE_FILE]
    ordered.append(T.StructField(SOURCE_FILE, T.StringType()))
    write_text(spark, f"{table}/schema.json", T.StructType(ordered).json())


def _schema(spark: SparkSession, table: str) -> T.StructType | None:
    path = f"{table}/schema.json"
    if not exists(spark, path):
        return None
    return T.StructType.fromJson(json.loads(read_text(spark, path)))


def update_trips(
    spark: SparkSession, folders: Sequence[str], table: str
) -> dict[str, list[str]]:
    """Bring the table in line with the trip files of some folders; returns names by what was done.

    New files are added and changed ones replaced, each in its own folder, while the rest of the
    table is not touched. When a file has changed (or there is no table yet) the table ends up with
    the present files only; otherwise rows of files that are gone stay.
    """
    listing = cut_lineage(classify(trip_files(list_folders(spark, folders)), load_manifest(spark, table)))
    done: dict[str, list[str]] = {"loaded": [], "dropped": []}
    stored = _stored(spark, table)
    todo = (listing.where(F.col("status") != "unchanged") if stored else listing).orderBy("name").collect()
    if not todo:
        return done
    rebuild = not stored or needs_rebuild(listing).first()["rebuild"]

    done["loaded"] = [f["name"] for f in todo]
    before = cut_lineage(_data_files(spark, table))
    paths = spark.createDataFrame([(f["path"],) for f in todo], "path string")
    _write(spark, read_trip_csv(paths, [qualified(spark, f) for f in folders]), table)

    # A file that has no rows any more writes no folder, so the old one is still there, as it was.
    fresh = _data_files(spark, table).join(before, "name", "left_anti").select(SOURCE_FILE).distinct()
    written = {r[SOURCE_FILE] for r in fresh.collect()}
    emptied = [n for n in done["loaded"] if n in stored and n not in written]
    present = {r["name"] for r in listing.select("name").collect()}
    gone = [name for name in stored if name not in present] if rebuild else []
    done["dropped"] = sorted([*emptied, *gone])
    for name in done["dropped"]:
        remove(spark, stored[name])
    save_manifest(listing, table)
    return done


def read_trips(spark: SparkSession, table: str) -> DataFrame:
    """The trips table under its recorded schema; columns a file lacks are null."""
    schema = _schema(spark, table)
    if schema is None:
        raise FileNotFoundError(f"no trips table at {table}")
    return spark.read.schema(schema).parquet(f"{table}/data")
