"""Feature table to model: split, search or reuse parameters, fit, score, log."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demand_engine.functions.times import DAYS_PER_MONTH
from demand_engine.operators.boosting import SEED, Settings, boost, save_boosted
from demand_engine.operators.demand import demand_features
from demand_engine.operators.modeling import (
    SEARCH_SPACE,
    TEST,
    TEST_MONTHS,
    TRAIN,
    TRIALS,
    VALIDATION,
    Range,
    best_parameters,
    chronological_split,
    evaluate,
    search,
    split_counts,
    with_tuned_prefix,
)
from demand_engine.schemas import FEATURE_COLUMNS
from demand_engine.session import cut_lineage, workspace
from demand_engine.sources.datasets import load_runs, log_run


def train(
    trips: DataFrame,
    model_path: str,
    runs_path: str,
    as_of: datetime | None = None,
    trials: int = TRIALS,
    test_months: int = TEST_MONTHS,
    order_by: str | None = None,
    space: Mapping[str, Range] = SEARCH_SPACE,
    days_per_month: int = DAYS_PER_MONTH,
) -> dict[str, object]:
    """Fit on everything before the test window, score on it, save the model, log the run.

    An empty window is an error before anything is fitted. A search stops each trial by its error on
    the validation window; the final fit has as many rounds as the best trial's best. Parameters in the
    log that boosting doesn't know are logged again and have no effect.

    The feature table is written once to the reliable checkpoint folder, since each fit reads it
    many times. Parameters of the best logged run are reused; only without any is there a search.
    """
    spark, started = trips.sparkSession, datetime.now()
    with workspace(spark, "train"):
        features = demand_features(trips, order_by, ordered=False)
        data = cut_lineage(
            chronological_split(
                features, as_of or started, test_months, days_per_month=days_per_month
            )
        )

        sizes = split_counts(data).first().asDict()
        if empty := [name for name, rows in sizes.items() if not rows]:
            raise ValueError(f"nothing to fit or to score: {', '.join(empty)} is 0")

        params = best_parameters(load_runs(spark, runs_path))
        if params is None:
            best = search(data, trials, space)[0]
            params = {**best["params"], "n_estimators": best["rounds"]}
        known = {k: v for k, v in params.items() if k in Settings.__dataclass_fields__}
        [model] = boost(data.where(F.col("split").isin(TRAIN, VALIDATION)), [known])
        metrics = evaluate(model, data.where(F.col("split") == TEST))
        save_boosted(spark, model, model_path)
        logged = {
            "random_state": SEED,
            "test_months": test_months,
            "features": list(FEATURE_COLUMNS),
            **with_tuned_prefix(params),
        }
        run_id = log_run(spark, runs_path, logged, metrics, started)
        return {"run_id": run_id, "params": params, "metrics": metrics}
