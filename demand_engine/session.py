"""Session settings and the folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def engine_session(app: str = "demand_engine", master: str | None = None) -> SparkSession:
    """A session with the rules the engine relies on: UTC, ANSI on, adaptive execution on.

    `master` is only for local runs; on a cluster the launcher sets it. Partition counts are left
    to the launcher and to adaptive execution.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    return (builder.master(master) if master else builder).getOrCreate()


def is_local(master: str) -> bool:
    """Whether a master string runs tasks in the driver's own process."""
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in `spark.checkpoint.dir`.

    Only where that is unset and all tasks run in this very process (`local[...]`) is a local folder
    made and set; on a cluster an unset folder is an error, since no executor sees another's disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        master = spark.sparkContext.master
        if not is_local(master):
            raise RuntimeError(f"spark.checkpoint.dir has to name a shared folder when the master is {master}")
        named = tempfile.mkdtemp(prefix="demand_engine-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


#: The folder of the job that is running, if it has one.
_job_folder: ContextVar[str | None] = ContextVar("job_folder", default=None)


@contextmanager
def workspace(spark: SparkSession, name: str) -> Iterator[str]:
    """A folder for all intermediate tables of a job, deleted when the job ends, well or not.

    What the job returns must not read them any more.
    """
    folder = scratch_path(spark, name)
    before = _job_folder.set(folder)
    try:
        yield folder
    finally:
        _job_folder.reset(before)
        where = spark._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path that nothing else uses, in the running job's folder or else under the shared one."""
    return os.path.join(_job_folder.get() or shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` as a table to the shared folder and read it back.

    For a table that is read many times: lost executors cost no recomputation of it, and unlike a
    checkpoint it is columnar, so that each reader takes only the columns and rows it needs. Its
    columns are known, so no job looks for them in the files.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
