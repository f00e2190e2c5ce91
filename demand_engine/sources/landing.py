"""Archives of CSV files, unpacked into a folder."""

from __future__ import annotations

import uuid
import zipfile
from collections.abc import Iterator
from typing import IO

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demand_engine.sources.files import (
    base_name,
    created,
    exists,
    list_objects,
    opened,
    qualified,
    spread,
)

_CHUNK = 4 * 1024 * 1024
_MEMBERS = "archive string, member string, bytes bigint"


def copy_without_nul(source: IO[bytes], target: IO[bytes]) -> int:
    """Copy chunk by chunk, leaving out NUL bytes; the number of bytes written."""
    written = 0
    while chunk := source.read(_CHUNK):
        clean = chunk.replace(b"\x00", b"")
        target.write(clean)
        written += len(clean)
    return written


def _list_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path in batch["path"]:
            with opened(path) as stream, zipfile.ZipFile(stream) as archive:
                members = [m for m in archive.infolist() if m.filename.endswith(".csv")]
            yield pd.DataFrame(
                {
                    "archive": [path] * len(members),
                    "member": [m.filename for m in members],
                    "bytes": [m.file_size for m in members],
                }
            )


def archive_members(spark: SparkSession, source_dir: str) -> DataFrame:
    """The CSV members of all archives in a folder: (file, archive, member, bytes).

    `file` is the member's name without folders. Only the archives' directories are read.
    """
    archives = list_objects(spark, source_dir).where(F.col("name").contains(".zip"))
    return (
        spread(archives.select("path"))
        .mapInPandas(_list_members, _MEMBERS)
        .select(base_name(F.col("member")).alias("file"), "*")
    )


def unpack(spark: SparkSession, source_dir: str, raw_dir: str) -> DataFrame:
    """Write the CSV members of all archives into `raw_dir`, without their folders and NUL bytes.

    Of members with the same name the first by archive and member counts, and a file that is
    already there stays. A compressed member cannot be split, so one task streams it, in chunks of
    fixed size; different members of one archive go to different tasks. A repeated task writes the
    same file again. Returns (file, bytes) of what was written.
    """
    first = (
        archive_members(spark, source_dir)
        .groupBy("file")
        .agg(
            F.min_by(
                F.struct("archive", "member"), F.struct("archive", "member")
            ).alias("source")
        )
        .select("file", "source.*")
    )
    wanted = first
    if exists(spark, raw_dir):
        have = list_objects(spark, raw_dir).select(F.col("name").alias("file"))
        wanted = first.join(have, "file", "left_anti")
    target = qualified(spark, raw_dir).rstrip("/")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                with (
                    created(f"{target}/{row.file}", uuid.uuid4().hex) as out,
                    opened(row.archive) as stream,
                    zipfile.ZipFile(stream) as archive,
                    archive.open(row.member) as member,
                ):
                    size = copy_without_nul(member, out)
                yield pd.DataFrame({"file": [row.file], "bytes": [size]})

    done = spread(wanted).mapInPandas(write, "file string, bytes bigint").collect()
    return spark.createDataFrame(done, "file string, bytes bigint")
