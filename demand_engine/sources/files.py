"""Files on any Hadoop path: listing, existence, small texts, streams inside tasks."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from typing import IO, Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _hadoop(spark: SparkSession, path: str) -> tuple[Any, Any]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at `path`. Only "not found" is False; other errors are raised."""
    if not path:
        return False
    fs, where = _hadoop(spark, path)
    return bool(fs.exists(where))


def qualified(spark: SparkSession, path: str) -> str:
    """The full URI of a path, as listings show it."""
    fs, where = _hadoop(spark, path)
    return where.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _hadoop(spark, path)
    fs.delete(where, True)


def rename(spark: SparkSession, path: str, new: str) -> None:
    fs, where = _hadoop(spark, path)
    if not fs.rename(where, spark._jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"{path} can't be renamed to {new}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, where = _hadoop(spark, path)
    out = fs.create(where, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _hadoop(spark, path)
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under `path`."""
    if not exists(spark, path):
        return []
    fs, where = _hadoop(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()]


def list_objects(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """The files under a folder: (name, path, modified, mtime, length).

    `name` is the path below `root`, `mtime` whole seconds. Folders are not listed, nor are hidden
    files (names starting with a dot or underscore). File contents are not read.
    """
    base = qualified(spark, root).rstrip("/") + "/"
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "modificationTime", "length")
    )
    name = F.substr("path", F.lit(len(base) + 1))
    return files.select(
        name.alias("name"),
        "path",
        F.col("modificationTime").cast("timestamp_ntz").alias("modified"),
        F.unix_seconds("modificationTime").alias("mtime"),
        "length",
    ).where(F.col("name").startswith(prefix) & ~F.col("name").endswith("/"))


def list_folders(spark: SparkSession, roots: Sequence[str]) -> DataFrame:
    """The files of several folders in one listing; of equal names the first folder's file counts."""
    listings = [
        list_objects(spark, root).withColumn("__rank", F.lit(i)) for i, root in enumerate(roots)
    ]
    if len(listings) == 1:
        return listings[0].drop("__rank")
    rows = reduce(DataFrame.unionByName, listings)
    first = F.min_by(F.struct("path", "modified", "mtime", "length"), "__rank").alias("first")
    return rows.groupBy("name").agg(first).select("name", "first.*")


def base_name(name: Column) -> Column:
    return F.element_at(F.split(name, "/"), -1)


def trip_files(listing: DataFrame) -> DataFrame:
    """The trip files of a listing, by name: CSV files with "trip" in their own name, not a folder's."""
    own = base_name(F.col("name"))
    return listing.where(own.endswith(".csv") & own.contains("trip")).orderBy("name")


def matching(listing: DataFrame, pattern: str) -> DataFrame:
    """The files whose base name (or name, if the pattern has a slash) fits a pattern."""
    name = F.col("name") if "/" in pattern else base_name(F.col("name"))
    return listing.where(name.rlike("^" + fnmatch.translate(pattern)))


def name_below(path: Column, roots: Sequence[str]) -> Column:
    """The listing name of a path: what follows the folder it lies in."""
    name = F.lit(None).cast("string")
    for root in sorted(roots, key=len):
        base = root.rstrip("/") + "/"
        name = F.when(path.startswith(base), F.substr(path, F.lit(len(base) + 1))).otherwise(name)
    return name


def spread(files: DataFrame) -> DataFrame:
    """Deal a file list over the cluster, for tasks that work through whole files."""
    return files.repartition(4 * files.sparkSession.sparkContext.defaultParallelism)


def decoded_path(metadata_path: Column) -> Column:
    """The path in `_metadata.file_path`, which Spark shows percent-encoded, as listings show it."""
    return F.url_decode(F.replace(metadata_path, F.lit("+"), F.lit("%2B")))


def _arrow_path(uri: str) -> tuple[Any, str]:
    from pyarrow import fs

    scheme = re.match(r"^([a-z0-9]+):", uri)
    if scheme is None or scheme[1] == "file":
        return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", uri)
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


@contextmanager
def opened(uri: str) -> Iterator[IO[bytes]]:
    """A seekable input stream, for use inside a task."""
    filesystem, path = _arrow_path(uri)
    with filesystem.open_input_file(path) as stream:
        yield stream


@contextmanager
def created(uri: str, attempt: str) -> Iterator[IO[bytes]]:
    """An output stream, for use inside a task; the file appears under its name when complete.

    Until then it has a hidden name of its own, so a lost or repeated attempt leaves no half file.
    """
    filesystem, path = _arrow_path(uri)
    folder, _, name = path.rpartition("/")
    filesystem.create_dir(folder, recursive=True)
    hidden = f"{folder}/.{name}.{attempt}"
    with filesystem.open_output_stream(hidden) as stream:
        yield stream
    filesystem.move(hidden, path)
    checksum = f"{folder}/.{name}.crc"  # local Hadoop file systems keep one; it would be stale
    if filesystem.type_name == "local" and filesystem.get_file_info(checksum).is_file:
        filesystem.delete_file(checksum)
