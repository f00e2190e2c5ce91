"""Splits, metrics, run log and models."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demand_engine.functions.measures import TUNED_PREFIX
from demand_engine.operators import modeling as M
from demand_engine.operators.boosting import PATIENCE, SEED, boost, load_boosted, root_cuts, save_boosted
from demand_engine.operators.demand import FIRST_OF_TRIP, demand_features
from demand_engine.operators.report import prediction_report
from demand_engine.plans.prepare import whole_days
from demand_engine.plans.train import train
from demand_engine.queries.registry import query
from demand_engine.queries.views import enriched, features_sql, sql, table, trips
from demand_engine.schemas import FEATURE_COLUMNS, WEATHER_FILLS
from demand_engine.session import cut_lineage, scratch_path
from demand_engine.sources.datasets import load_model, load_runs, log_run, save_model

_AS_OF = datetime(2001, 8, 1)
_SPLIT_SQL = """SELECT o_orderkey, o_orderdate,
        CASE WHEN o_orderdate >= TIMESTAMP '2001-08-01' - INTERVAL 90 DAY THEN 'test'
            WHEN o_orderdate >= (SELECT max(o_orderdate) FROM orders
                WHERE o_orderdate < TIMESTAMP '2001-08-01' - INTERVAL 90 DAY) - INTERVAL 90 DAY
            THEN 'val' ELSE 'train' END AS split FROM orders"""

# Windows of ten days, since the events cover a month.
_JANUARY_END = datetime(2024, 1, 31)


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return M.chronological_split(orders, _AS_OF, time_col="o_orderdate")


@query(_SPLIT_SQL)
def chronological_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir)


@query(
    f"""SELECT count(*) FILTER (WHERE split = 'train') AS train_rows,
        count(*) FILTER (WHERE split = 'val') AS val_rows,
        count(*) FILTER (WHERE split = 'test') AS test_rows FROM ({_SPLIT_SQL})"""
)
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.split_counts(_split(spark, sf_dir))


@query(
    f"""SELECT o_orderkey, split FROM ({_SPLIT_SQL}) WHERE split = 'train'
    UNION ALL SELECT o_orderkey, split FROM ({_SPLIT_SQL}) WHERE split = 'val'"""
)
def train_and_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _split(spark, sf_dir).select("o_orderkey", "split")
    train_rows = rows.where(F.col("split") == M.TRAIN)
    return train_rows.unionByName(rows.where(F.col("split") == M.VALIDATION))


_METRICS_SQL = """SELECT round(sqrt(avg(e * e)), 4) AS rmse, round(avg(abs(e)), 4) AS mae,
        round(1 - sum(e * e) / (var_pop(l_extendedprice) * count(*)), 6) AS r2
    FROM (SELECT *, l_extendedprice - l_quantity * 2000 AS e FROM lineitem)"""


def _price_guesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias("label"),
        (F.col("l_quantity") * 2000).alias("prediction"),
    )


def _rounded_metrics(df: DataFrame) -> DataFrame:
    digits = {"rmse": 4, "mae": 4, "r2": 6}
    return df.select(*(F.round(c, n).alias(c) for c, n in digits.items()))


@query(_METRICS_SQL)
def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_metrics(M.regression_metrics(_price_guesses(spark, sf_dir)))


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a training run: its price is the error, some fields are parameters."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.col("o_orderdate").alias("start_time"),
        F.create_map(
            F.lit("random_state"), F.lit("42"),
            F.lit("tuned_max_depth"), F.col("o_custkey").cast("string"),
            F.lit("tuned_subsample"), F.concat(F.lit("0."), F.col("o_custkey") + 1),
            F.lit("tuned_reg_alpha"), F.concat(F.col("o_custkey") + 1, F.lit("e-05")),
            F.lit("tuned_booster"), F.col("o_orderpriority"),
            F.lit("tuned_reg_lambda"), F.lit("nan"),
        ).alias("params"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("rmse"),
        F.lit(None).cast("double").alias("mae"),
        F.lit(None).cast("double").alias("r2"),
    )


@query(
    """SELECT cast(o_orderkey AS varchar) AS run_id, o_orderdate AS start_time,
        o_totalprice AS rmse, cast(o_custkey AS varchar) AS max_depth
    FROM orders WHERE o_orderstatus <> 'P'
    ORDER BY o_totalprice, o_orderdate DESC, cast(o_orderkey AS varchar) LIMIT 1"""
)
def best_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = M.best_run(_runs(spark, sf_dir))
    return best.select(
        "run_id", "start_time", "rmse", F.col("params")["tuned_max_depth"].alias("max_depth")
    )


def _parameters_sql(alpha_number: bool) -> str:
    alpha = "CASE WHEN {0} THEN cast(concat(o_custkey + 1, 'e-05') AS double) END"
    text = "CASE WHEN NOT {0} THEN concat(o_custkey + 1, 'e-05') END"
    return f"""SELECT cast(o_orderkey AS varchar) AS run_id, unnest([
            {{'name': 'max_depth', 'whole': o_custkey, 'fraction': NULL::double, 'text': NULL}},
            {{'name': 'subsample', 'whole': NULL,
              'fraction': cast(concat('0.', o_custkey + 1) AS double), 'text': NULL}},
            {{'name': 'reg_alpha', 'whole': NULL, 'fraction': {alpha.format(alpha_number)},
              'text': {text.format(alpha_number)}}},
            {{'name': 'booster', 'whole': NULL, 'fraction': NULL, 'text': o_orderpriority}}
        ], recursive := true) FROM orders"""


@query(_parameters_sql(True))
def parse_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.tuned_parameters(_runs(spark, sf_dir))


@query(_parameters_sql(False))
def parse_params_digits_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only plain digits count as numbers; exponents stay text."""
    return M.tuned_parameters(_runs(spark, sf_dir), digits_only=True)


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split_features(enriched(spark, sf_dir))


def _split_features(trips: DataFrame) -> DataFrame:
    """Features with a split, written once, as a training job does."""
    rows = demand_features(trips, "ride_id", ordered=False)
    return cut_lineage(M.chronological_split(rows, _JANUARY_END, 1, days_per_month=10))


@query(
    sql(
        f"""SELECT datetime, station, demand::double AS label, [hour, weekday, month, year,
                is_weekend::int, total_docks, lat, lng, temp, rhu, prcp, wspd, wdir, snow]::double[] AS v,
            {', '.join(f'v[{i + 1}] AS f{i}' for i in range(14))},
            CASE WHEN datetime >= TIMESTAMP '2024-01-21' THEN 'test'
                WHEN datetime >= (SELECT max(datetime) FROM features
                    WHERE datetime < TIMESTAMP '2024-01-21') - INTERVAL 10 DAY THEN 'val'
                ELSE 'train' END AS split
        FROM features""",
        "hours",
        features=features_sql(),
    ).replace("SELECT datetime, station, demand::double", "SELECT * EXCLUDE (v) FROM (SELECT datetime, station, demand::double")
    + ")"
)
def feature_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors' elements, in order, as columns."""
    keys = _features(spark, sf_dir)
    matrix = M.feature_matrix(keys, keep=("datetime", "station", "split"))
    vector = matrix.withColumn("v", vector_to_array("features"))
    return vector.select(
        "datetime", "station", "label", "split",
        *(
            (F.round(F.col("v")[i], 6) if c in WEATHER_FILLS else F.col("v")[i]).alias(f"f{i}")
            for i, c in enumerate(FEATURE_COLUMNS)
        ),
    )


@query()
def train_and_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained on what is before the test window; the metrics of the test rows."""
    data = _features(spark, sf_dir)
    known = data.where(F.col("split") != M.TEST)
    model = M.train_model(known)
    scored = model.transform(data.where(F.col("split") == M.TEST))
    return M.regression_metrics(scored, "demand")


_SPLIT_FEATURES = """(SELECT *, CASE WHEN datetime >= TIMESTAMP '2024-01-21' THEN 'test'
        WHEN datetime >= (SELECT max(datetime) FROM features
            WHERE datetime < TIMESTAMP '2024-01-21') - INTERVAL 10 DAY THEN 'val'
        ELSE 'train' END AS split FROM features)"""


def _held_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _features(spark, sf_dir).where(F.col("split") != M.TEST)
    return rows.withColumn("held_out", F.col("split") == M.VALIDATION)


def _rounded_rmse(error: str) -> str:
    return f"round(sqrt(avg(({error}) * ({error}))), 9)"


@query(
    sql(
        f"""SELECT count(*) FILTER (WHERE split = 'train') AS train_rows,
            count(*) FILTER (WHERE split = 'val') AS held_out_rows,
            {_rounded_rmse("CASE WHEN split = 'val' THEN demand - (SELECT avg(demand) FROM " + _SPLIT_FEATURES + " WHERE split = 'train') END")}
                AS rmse_before, 50 AS patience, true AS rmse_agrees, true AS ended_in_time, true AS first_least_chosen
        FROM {_SPLIT_FEATURES}""",
        "hours",
        features=features_sql(),
    )
)
def early_stopping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosting until fifty rounds after the least error, checked from the predictions of every round.

    The error before the first round is the mean's; those after are compared with what an aggregation
    of the held-out rows' predictions gives, round by round.
    """
    rows, most = _held_out(spark, sf_dir), 400
    [model] = boost(rows, [{"max_depth": 3, "n_estimators": most}], "held_out")
    by_round = model.predictions_by_round(rows.where("held_out")).select("demand", F.posexplode("prediction").alias("round", "p"))
    error = F.col("demand") - F.col("p")
    recomputed = by_round.groupBy("round").agg(F.sqrt(F.avg(error * error)).alias("rmse"))
    watched = spark.createDataFrame(list(enumerate(model.errors)), "round int, watched double")
    both = watched.join(recomputed, "round", "left").withColumn("agrees", F.abs(F.col("rmse") - F.col("watched")) < 1e-9)
    after = F.col("round") > 0
    best = F.min_by(F.when(after, F.col("round")), F.when(after, F.struct("watched", "round")))
    sizes = rows.agg(F.count_if(~F.col("held_out")).alias("train_rows"), F.count_if("held_out").alias("held_out_rows")).first()
    return both.agg(
        F.lit(sizes["train_rows"]).cast("bigint").alias("train_rows"),
        F.lit(sizes["held_out_rows"]).cast("bigint").alias("held_out_rows"),
        F.round(F.max(F.when(F.col("round") == 0, F.col("rmse"))), 9).alias("rmse_before"),
        F.lit(PATIENCE).alias("patience"),
        F.every(F.coalesce("agrees", F.lit(False))).alias("rmse_agrees"),
        (F.max("round") == F.least(best + PATIENCE, F.lit(most))).alias("ended_in_time"),
        (best == model.rounds).alias("first_least_chosen"),
    )


def _drawn_sql(name: str, r: M.Range) -> str:
    part = f"(CAST('0x' || substr(md5('{SEED}:' || trial || ':{name}'), 1, 13) AS BIGINT) / CAST({16**13} AS DOUBLE))"
    if r.whole:
        return f"CAST({r.low:.0f} + floor({part} * {r.high - r.low + 1:.0f}) AS BIGINT) AS {name}"
    value = f"exp(ln({r.low!r}) + {part} * (ln({r.high!r}) - ln({r.low!r})))" if r.log else f"{r.low!r} + {part} * {r.high - r.low!r}"
    return f"round({value}, 9) AS {name}"


@query(
    f"""SELECT trial, {', '.join(_drawn_sql(n, r) for n, r in M.SEARCH_SPACE.items())},
        true AS ended_in_time, true AS in_order FROM (SELECT unnest(range({M.TRIALS})) AS trial)"""
)
def random_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole search: per trial its nine drawn parameters, whether it ended fifty rounds after its least
    error (or with its last round), and whether no trial behind it is better."""
    found = M.search(_features(spark, sf_dir))
    rows = []
    for place, t in enumerate(found):
        params = [int(v) if M.SEARCH_SPACE[k].whole else round(v, 9) for k, v in t["params"].items()]
        ended = len(t["errors"]) - 1 == min(t["rounds"] + PATIENCE, t["params"]["n_estimators"])
        least = t["errors"][t["rounds"]] == min(t["errors"][1:])
        rows.append((t["trial"], *params, ended and least, all(t["rmse"] <= u["rmse"] for u in found[place:])))
    kinds = ", ".join(f"{n} {'bigint' if r.whole else 'double'}" for n, r in M.SEARCH_SPACE.items())
    return spark.createDataFrame(rows, f"trial bigint, {kinds}, ended_in_time boolean, in_order boolean")


@query(
    sql(
        f"""SELECT run, (SELECT count(*) FROM {_SPLIT_FEATURES} WHERE split = 'test') AS test_rows,
            9 AS tuned, true AS metrics_agree, true AS same_parameters FROM (SELECT unnest([1, 2]) AS run)""",
        "hours",
        features=features_sql(),
    )
)
def training_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job twice: the second run reuses the parameters the first has found and logged.

    Per run: the test rows, the number of tuned parameters in the log, whether the metrics in the log are
    those of the saved model on the test rows, and whether both runs logged the same parameters.
    The trips are enriched once and written, with the columns that features are made of, since three jobs
    read them; they are dealt by their id before, as the few files of a small table would be few tasks.
    """
    path = scratch_path(spark, "training")
    rides = enriched(spark, sf_dir, trips(spark, sf_dir).repartition("ride_id"))
    known = cut_lineage(rides.select("ride_id", "started_at", "start_station_name", *FIRST_OF_TRIP, *WEATHER_FILLS))
    test = _split_features(known).where(F.col("split") == M.TEST)
    rows = []
    for run in (1, 2):
        done = train(
            known, f"{path}/model", f"{path}/runs", _JANUARY_END, test_months=1,
            order_by="ride_id", days_per_month=10,
        )
        again = M.evaluate(load_boosted(spark, f"{path}/model"), test)
        rows.append((run, done["run_id"], *(again[m] for m in ("rmse", "mae", "r2"))))
    seen = spark.createDataFrame(rows, "run int, run_id string, again_rmse double, again_mae double, again_r2 double")
    logged = load_runs(spark, f"{path}/runs")
    tuned = F.map_filter("params", lambda k, _: k.startswith(TUNED_PREFIX))
    listed = F.array_sort(F.map_entries(tuned))
    least, most = logged.agg(F.min(listed)).scalar(), logged.agg(F.max(listed)).scalar()
    agree = F.lit(True)
    for m in ("rmse", "mae", "r2"):
        agree &= F.abs(F.col(m) - F.col(f"again_{m}")) < 1e-9
    return seen.join(logged, "run_id").select(
        "run", F.lit(test.count()).cast("bigint").alias("test_rows"), F.size(tuned).alias("tuned"),
        agree.alias("metrics_agree"), (least == most).alias("same_parameters"),
    )


@query(
    sql(
        f"""SELECT name, round(edge, 6) AS edge, round(gain, 6) AS gain, round(left_mean, 6) AS left_mean, round(right_mean, 6) AS right_mean
        FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY gain DESC, edge) AS place FROM gains WHERE n_left >= 20 AND n - n_left >= 20)
        WHERE place = 1 AND gain > 1e-9""",
        "hours",
        features=features_sql(),
        fitted=f"SELECT * FROM {_SPLIT_FEATURES} WHERE split <> 'test'",
        entries="SELECT demand, unnest([" + ", ".join(
            f"{{'name': '{c}', 'v': CAST({c} AS DOUBLE)}}" for c in FEATURE_COLUMNS
        ) + "], recursive := true) FROM fitted",
        vals="SELECT name, v, count(*) AS n, sum(demand) AS s FROM entries GROUP BY name, v",
        below="""SELECT name, v, coalesce(sum(n) OVER before, 0) AS n_left, coalesce(sum(s) OVER before, 0) AS s_left,
            sum(n) OVER (PARTITION BY name) AS n, sum(s) OVER (PARTITION BY name) AS s
            FROM vals WINDOW before AS (PARTITION BY name ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
        parts="SELECT *, floor(n_left * 32 / n) AS part, lag(floor(n_left * 32 / n)) OVER (PARTITION BY name ORDER BY v) AS part_before FROM below",
        gains="""SELECT name, v AS edge, n_left, n, s_left / n_left AS left_mean, (s - s_left) / (n - n_left) AS right_mean,
            pow(s_left - n_left * s / n, 2) / n_left + pow(s - s_left - (n - n_left) * s / n, 2) / (n - n_left) AS gain
            FROM parts WHERE part <> part_before""",
    )
)
def boosting_root_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best first cut of every feature over all rows before the test window."""
    cuts = root_cuts(_features(spark, sf_dir).where(F.col("split") != M.TEST))
    return cuts.select("name", *(F.round(c, 6).alias(c) for c in ("edge", "gain", "left_mean", "right_mean")))


@query(
    sql(
        """SELECT model, count(*) AS scored_rows, CAST(0 AS BIGINT) AS differences FROM features, (SELECT unnest(['boosted', 'pipeline']) AS model)
        GROUP BY model""",
        "hours",
        features=features_sql(),
    )
)
def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of all feature rows before saving and after loading, for both kinds of model."""
    rows = _features(spark, sf_dir)
    known = rows.where(F.col("split") != M.TEST)
    [boosted] = boost(known, [{"n_estimators": 10, "max_depth": 4, "subsample": 0.8, "colsample_bytree": 0.8}])
    pipeline = M.train_model(known, {"max_depth": 4, "n_estimators": 5})
    path = scratch_path(spark, "model")
    pairs = {
        "boosted": (boosted, load_boosted(spark, save_boosted(spark, boosted, f"{path}/boosted"))),
        "pipeline": (pipeline, load_model(save_model(pipeline, f"{path}/pipeline"))),
    }
    scored = [
        saved.transform(before.transform(rows).select(*rows.columns, F.col("prediction").alias("before"))).select(
            F.lit(name).alias("model"), "before", "prediction"
        )
        for name, (before, saved) in pairs.items()
    ]
    differ = F.count_if(~F.col("before").eqNullSafe(F.col("prediction")) | F.col("before").isNull())
    return scored[0].unionByName(scored[1]).groupBy("model").agg(F.count(F.lit(1)).alias("scored_rows"), differ.alias("differences"))


@query(_METRICS_SQL)
def run_log_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics of all line items, logged as a run and read back as the best one."""
    path = scratch_path(spark, "runs")
    metrics = M.regression_metrics(_price_guesses(spark, sf_dir)).first().asDict()
    log_run(spark, path, {"tuned_max_depth": 4}, metrics, datetime(2024, 1, 1))
    return _rounded_metrics(M.best_run(load_runs(spark, path)))


@query()
def model_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report with a trained model that was saved and loaded."""
    trips = enriched(spark, sf_dir)
    known = _features(spark, sf_dir).where(F.col("split") != M.TEST)
    model = M.train_model(known)
    path = save_model(model, scratch_path(spark, "model"))
    days = whole_days(datetime(2024, 1, 1), datetime(2024, 1, 31))
    return prediction_report(trips, M.scorer(load_model(path)), *days, order_by="ride_id")
