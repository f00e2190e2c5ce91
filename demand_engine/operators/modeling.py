"""Feature vectors, chronological splits, boosted trees, metrics, parameter search."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demand_engine.functions.measures import TUNED_PREFIX, tuned_name, typed_parameter
from demand_engine.functions.times import DAYS_PER_MONTH, days_before, ntz
from demand_engine.operators.boosting import PATIENCE, SEED, Boosted, boost
from demand_engine.operators.tables import quoted
from demand_engine.schemas import FEATURE_COLUMNS

# Windows and search size of a training run.
TEST_MONTHS = 3
TRIALS = 20

TRAIN, VALIDATION, TEST = "train", "val", "test"

# Spark's trees go no deeper than this.
MAX_DEPTH = 30


@dataclass(frozen=True)
class Range:
    """The values a search may try for a parameter."""

    low: float
    high: float
    whole: bool = False
    log: bool = False

    def at(self, part: float) -> float | int:
        """The value below which `part` (0 to 1) of the draws lie."""
        if self.whole:
            return int(self.low) + int(part * (int(self.high) - int(self.low) + 1))
        if self.log:
            return math.exp(math.log(self.low) + part * (math.log(self.high) - math.log(self.low)))
        return self.low + part * (self.high - self.low)


def _uniform(seed: str) -> float:
    """A number in [0, 1) from a hash."""
    return int(hashlib.md5(seed.encode()).hexdigest()[:13], 16) / 16**13


# The search space.
SEARCH_SPACE = {
    "num_leaves": Range(16, 256, whole=True),
    "max_depth": Range(3, 15, whole=True),
    "learning_rate": Range(0.01, 0.3, log=True),
    "n_estimators": Range(100, 2000, whole=True),
    "min_child_samples": Range(5, 100, whole=True),
    "subsample": Range(0.5, 1.0),
    "colsample_bytree": Range(0.5, 1.0),
    "reg_alpha": Range(1e-8, 10.0, log=True),
    "reg_lambda": Range(1e-8, 10.0, log=True),
}


def gbt_settings(params: Mapping[str, object]) -> dict[str, object]:
    """Search parameters as settings of Spark's boosted trees (`boosting` honours all of them itself).

    A leaf limit becomes the depth that could hold as many leaves. Penalties on leaf weights have
    no counterpart and are left out.
    """
    settings: dict[str, object] = {}
    depth = params.get("max_depth")
    if "num_leaves" in params:
        enough = math.ceil(math.log2(int(params["num_leaves"])))
        depth = enough if depth is None else min(int(depth), enough)
    if depth is not None:
        if int(depth) > MAX_DEPTH:
            raise ValueError(f"trees go no deeper than {MAX_DEPTH}: {depth}")
        settings["maxDepth"] = int(depth)
    if "n_estimators" in params:
        settings["maxIter"] = int(params["n_estimators"])
    if "learning_rate" in params:
        settings["stepSize"] = float(params["learning_rate"])
    if "min_child_samples" in params:
        settings["minInstancesPerNode"] = int(params["min_child_samples"])
    if "subsample" in params:
        settings["subsamplingRate"] = float(params["subsample"])
    if "colsample_bytree" in params:
        settings["featureSubsetStrategy"] = str(float(params["colsample_bytree"]))
    return settings


def chronological_split(
    df: DataFrame,
    as_of: datetime,
    months: int = TEST_MONTHS,
    time_col: str = "datetime",
    days_per_month: int = DAYS_PER_MONTH,
) -> DataFrame:
    """Add `split`: the last `months` before `as_of` (and later) are `test`, the last `months` of
    what is left are `val`, the rest is `train`. A row without a time belongs to none."""
    time, days = F.col(time_col), months * days_per_month
    test_from = days_before(ntz(as_of), days)
    last_pool = df.agg(F.max(F.when(time < test_from, time)).alias("last")).scalar()
    return df.withColumn(
        "split",
        F.when(time >= test_from, TEST)
        .when(time >= days_before(last_pool, days), VALIDATION)
        .when(time.isNotNull(), TRAIN),
    )


def split_counts(df: DataFrame) -> DataFrame:
    """One row: size of each split."""
    return df.agg(
        *(F.count_if(F.col("split") == s).alias(f"{s}_rows") for s in (TRAIN, VALIDATION, TEST))
    )


def assembler(columns: Sequence[str] = FEATURE_COLUMNS) -> VectorAssembler:
    """Feature vector in declared order; a null is an error, since incomplete rows are gone."""
    return VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="error")


def feature_matrix(
    df: DataFrame, label: str = "demand", keep: Sequence[str] = ()
) -> DataFrame:
    """(features, label) of each row, and the columns to keep beside them."""
    rows = df.withColumn("label", quoted(label).cast("double"))
    return assembler().transform(rows).select(*keep, "features", "label")


def _vectors(df: DataFrame, label: str, keep: Sequence[str] = ()) -> DataFrame:
    rows = df.select(*FEATURE_COLUMNS, F.col(label).cast("double").alias("label"), *keep)
    return assembler().transform(rows)


def _trees(params: Mapping[str, object], seed: int) -> GBTRegressor:
    trees = GBTRegressor(featuresCol="features", labelCol="label", seed=seed)
    return trees.setParams(**gbt_settings(params))


def train_model(
    df: DataFrame,
    params: Mapping[str, object] | None = None,
    label: str = "demand",
    seed: int = SEED,
) -> PipelineModel:
    """Boosted regression trees on the feature table."""
    fitted = _trees(params or {}, seed).fit(_vectors(df, label))
    return PipelineModel(stages=[assembler(), fitted])


def scorer(model: PipelineModel | Boosted):
    """Adds the model's `prediction` to a feature table."""
    return lambda features: model.transform(features)


def regression_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """One row (rmse, mae, r2) in a single pass; r2 from the label's variance in the same rows.

    Where all labels are equal, r2 is 1 for predictions without error and 0 for others.
    """
    y, error = F.col(label).cast("double"), F.col(label) - F.col(prediction)
    squares = F.sum(error * error)
    spread = F.var_pop(y) * F.count(y)
    constant = F.when(F.max(y) == F.min(y), F.when(squares == 0, 1.0).otherwise(0.0))
    return df.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.coalesce(constant, F.lit(1.0) - F.try_divide(squares, spread)).alias("r2"),
    )


def evaluate(model: PipelineModel | Boosted, df: DataFrame, label: str = "demand") -> dict[str, float]:
    return regression_metrics(model.transform(df), label).first().asDict()


def drawn_parameters(trial: int, space: Mapping[str, Range] = SEARCH_SPACE, seed: int = SEED) -> dict[str, float | int]:
    """The parameters of a trial; each is drawn by a hash of seed, trial and name."""
    return {name: r.at(_uniform(f"{seed}:{trial}:{name}")) for name, r in space.items()}


def search(
    df: DataFrame,
    trials: int = TRIALS,
    space: Mapping[str, Range] = SEARCH_SPACE,
    label: str = "demand",
    seed: int = SEED,
    patience: int = PATIENCE,
) -> list[dict[str, object]]:
    """Random search: fit on `train`, stop early by `val`; the trials, best first, with their rounds and errors.

    All trials grow from one binned table (`boosting.boost`): side by side, a task each, where it is small,
    else in the same passes, so that a search reads the data as often as its longest trial alone would.
    """
    drawn = [drawn_parameters(number, space, seed) for number in range(trials)]
    rows = df.where(F.col("split").isin(TRAIN, VALIDATION)).withColumn(
        "held_out", F.col("split") == VALIDATION
    )
    grown = boost(rows, drawn, "held_out", label, patience, seed, keep_trees=False)
    results = [
        {"trial": k, "rmse": m.rmse, "rounds": m.rounds, "errors": m.errors, "params": drawn[k]}
        for k, m in enumerate(grown)
    ]
    return sorted(results, key=lambda t: (t["rmse"], t["trial"]))


def best_run(runs: DataFrame) -> DataFrame:
    """The run with the lowest rmse (at most one row); among equals the latest, then the least id."""
    return runs.orderBy(
        F.col("rmse").asc_nulls_last(), F.col("start_time").desc_nulls_last(), "run_id"
    ).limit(1)


def tuned_parameters(runs: DataFrame, digits_only: bool = False) -> DataFrame:
    """The tuned parameters of each run: (run_id, name, whole, fraction, text); "nan" is left out."""
    entries = runs.select("run_id", F.explode("params").alias("logged", "value"))
    typed = typed_parameter(F.col("value"), digits_only)
    return (
        entries.withColumn("name", tuned_name(F.col("logged")))
        .where(F.col("name").isNotNull() & (F.lower("value") != "nan"))
        .select("run_id", "name", typed.alias("v"))
        .select("run_id", "name", "v.*")
    )


def best_parameters(runs: DataFrame, digits_only: bool = False) -> dict[str, object] | None:
    """Tuned parameters of the best run, or None when there is no run or none were tuned."""
    rows = tuned_parameters(best_run(runs), digits_only).collect()
    values = {
        r["name"]: next((v for v in (r["whole"], r["fraction"]) if v is not None), r["text"])
        for r in rows
    }
    return values or None


def with_tuned_prefix(params: Mapping[str, object]) -> dict[str, object]:
    return {TUNED_PREFIX + name: value for name, value in params.items()}
