"""The report of a time range and what is shown of it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from demand_engine.operators.report import (
    Scorer,
    hour_axis,
    hour_summary,
    map_columns,
    prediction_report,
    summary_text,
)
from demand_engine.sources.datasets import load_table, save_table


def write_report(
    spark: SparkSession, trips: DataFrame, score: Scorer, start: datetime, end: datetime, work_dir: str
) -> list[str]:
    """Write `report`, and from it `report_hours`, `report_summary` and `report_map`; their paths."""
    paths = [save_table(prediction_report(trips, score, start, end), f"{work_dir}/report")]
    report = load_table(spark, paths[0])
    products = {
        "report_hours": hour_axis(report),
        "report_summary": summary_text(hour_summary(report)),
        "report_map": map_columns(report),
    }
    return paths + [save_table(rows, f"{work_dir}/{name}") for name, rows in products.items()]
