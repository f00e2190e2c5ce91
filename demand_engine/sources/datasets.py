"""Parquet tables, whole and date-partitioned, models and the run log."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demand_engine.operators.tables import DATE_PARTITION
from demand_engine.sources.files import exists

RUN_SCHEMA = (
    "run_id string, start_time timestamp_ntz, params map<string,string>, "
    "rmse double, mae double, r2 double"
)


def save_table(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_trips(df: DataFrame, path: str) -> str:
    """Write standardised trips, one folder per start date, so that time ranges read few files.

    The rebalance hint lets Spark size the output: a busy date is split over several tasks and
    files, quiet dates share a task.
    """
    dated = df.withColumn(DATE_PARTITION, F.to_date("started_at"))
    dated.hint("rebalance", DATE_PARTITION).write.mode("overwrite").partitionBy(
        DATE_PARTITION
    ).parquet(path)
    return path


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def log_run(
    spark: SparkSession,
    path: str,
    params: Mapping[str, object],
    metrics: Mapping[str, float],
    start_time,
) -> str:
    """Append one training run to the log; returns its id."""
    run_id = uuid.uuid4().hex
    row = (
        run_id,
        start_time,
        {k: str(v) for k, v in params.items()},
        *(float(metrics[m]) for m in ("rmse", "mae", "r2")),
    )
    spark.createDataFrame([row], RUN_SCHEMA).write.mode("append").parquet(path)
    return run_id


def load_runs(spark: SparkSession, path: str) -> DataFrame:
    """The run log; empty where none was written yet or where what is there can't be read."""
    if exists(spark, path):
        runs = spark.read.schema(RUN_SCHEMA).parquet(path)
        try:
            runs.agg(F.count("run_id"), F.max("start_time"), F.max("rmse"), F.max(F.size("params"))).first()
            return runs
        except (PySparkException, Py4JJavaError):
            logging.getLogger(__name__).warning("the run log at %s can't be read", path)
    return spark.createDataFrame([], RUN_SCHEMA)
