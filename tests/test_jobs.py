import os
import random
import zipfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from demand_engine.functions.times import hour_of
from demand_engine.operators import modeling as M
from demand_engine.operators.boosting import load_boosted
from demand_engine.operators.demand import demand_features, station_hours
from demand_engine.operators.report import prediction_report
from demand_engine.operators.weather import clamped
from demand_engine.plans.prepare import prepare, refresh, whole_days
from demand_engine.plans.report import write_report
from demand_engine.plans.train import train
from demand_engine.queries import views
from demand_engine.schemas import FEATURE_COLUMNS, VERSION_DATES, WEATHER_FILLS
from demand_engine.session import cut_lineage, shared_dir, workspace
from demand_engine.sources.dated_trips import current_state, read_dated, replace_dates
from demand_engine.sources.datasets import load_runs, load_table, log_run
from demand_engine.sources.stations_table import exact_files

SPACE = {
    "max_depth": M.Range(2, 3, whole=True),
    "n_estimators": M.Range(2, 3, whole=True),
    "num_leaves": M.Range(4, 4, whole=True),
    "reg_alpha": M.Range(1e-8, 10.0, log=True),
}


def test_windows(spark):
    as_of = datetime(2024, 7, 1)
    days = [as_of - timedelta(days=d) for d in (0, 90, 91, 180, 181, 182, 300)]
    df = spark.createDataFrame([(d,) for d in [*days, None]], "datetime timestamp_ntz")
    got = {r["datetime"]: r["split"] for r in M.chronological_split(df, as_of).collect()}
    assert [got[d] for d in days] == ["test", "test", "val", "val", "val", "train", "train"]
    assert got[None] is None
    assert tuple(M.split_counts(M.chronological_split(df, as_of)).first()) == (2, 3, 2)


def test_no_rows_before_the_test_window(spark):
    df = spark.createDataFrame([(datetime(2024, 7, 1),)], "datetime timestamp_ntz")
    assert M.chronological_split(df, datetime(2024, 7, 1)).first()["split"] == "test"


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (6.0, 3.0)], "label double, prediction double")
    rmse, mae, r2 = M.regression_metrics(df).first()
    assert rmse == pytest.approx((10 / 3) ** 0.5)
    assert mae == pytest.approx(4 / 3)
    assert r2 == pytest.approx(1 - 10 / 14)


def test_settings():
    got = M.gbt_settings({
        "num_leaves": 31, "max_depth": 15, "learning_rate": 0.1, "n_estimators": 200,
        "min_child_samples": 20, "subsample": 0.8, "colsample_bytree": 0.7, "reg_alpha": 1.0,
    })
    assert got == {
        "maxDepth": 5, "stepSize": 0.1, "maxIter": 200, "minInstancesPerNode": 20,
        "subsamplingRate": 0.8, "featureSubsetStrategy": "0.7",
    }
    assert set(M.SEARCH_SPACE) == {
        "num_leaves", "max_depth", "learning_rate", "n_estimators", "min_child_samples",
        "subsample", "colsample_bytree", "reg_alpha", "reg_lambda",
    }


def test_run_log_and_best_run(spark, tmp_path):
    path, when = str(tmp_path / "runs"), datetime(2024, 1, 1)
    assert M.best_parameters(load_runs(spark, path)) is None
    log_run(spark, path, {"random_state": 42}, {"rmse": 1.0, "mae": 1.0, "r2": 0.0}, when)
    assert M.best_parameters(load_runs(spark, path)) is None  # the best run has nothing tuned
    tuned = M.with_tuned_prefix({"max_depth": 4, "learning_rate": 1e-05, "booster": "gbt"})
    log_run(spark, path, tuned, {"rmse": 0.5, "mae": 1.0, "r2": 0.0}, when)
    log_run(spark, path, M.with_tuned_prefix({"max_depth": 9}),
            {"rmse": float("nan"), "mae": 1.0, "r2": 0.0}, when)
    runs = load_runs(spark, path)
    assert M.best_run(runs).first()["rmse"] == 0.5
    assert M.best_parameters(runs) == {"max_depth": 4, "learning_rate": 1e-05, "booster": "gbt"}
    strict = M.best_parameters(runs, digits_only=True)
    assert strict == {"max_depth": 4, "learning_rate": "1e-05", "booster": "gbt"}


def test_null_feature_is_an_error(spark):
    row = {c: 1.0 for c in FEATURE_COLUMNS} | {"demand": 1.0}
    df = spark.createDataFrame([row]).withColumn("temp", F.lit(None).cast("double"))
    with pytest.raises(Exception):
        M.feature_matrix(df).collect()


@pytest.fixture(scope="module")
def job(spark, small, tmp_path_factory):
    path = tmp_path_factory.mktemp("job")
    trips = views.enriched(spark, small)
    runs = [
        train(trips, f"{path}/model", f"{path}/runs", datetime(2024, 1, 31), 2, 1, "ride_id", SPACE, 10)
        for _ in range(2)
    ]
    return path, trips, runs


def test_second_training_run_reuses_parameters(spark, job):
    path, _, (first, second) = job
    assert set(first["params"]) == set(SPACE)
    assert second["params"] == pytest.approx(first["params"])
    assert second["metrics"] == pytest.approx(first["metrics"])
    logged = load_runs(spark, f"{path}/runs")
    assert logged.count() == 2
    assert {r["rmse"] for r in logged.collect()} == {first["metrics"]["rmse"], second["metrics"]["rmse"]}


def test_saved_model_predicts_whole_trips(spark, job):
    path, trips, _ = job
    model = load_boosted(spark, f"{path}/model")
    days = whole_days(datetime(2024, 1, 10), datetime(2024, 1, 20))
    report = prediction_report(trips, M.scorer(model), *days, order_by="ride_id")
    bad = report.where("predicted < 0 OR error <> actual - predicted OR predicted IS NULL")
    assert report.count() > 0 and bad.count() == 0
    low, high = report.agg(F.min("datetime"), F.max("datetime")).first()
    assert days[0] <= low and high <= days[1]


def test_search_is_repeatable_and_sorted(spark, small):
    rows = demand_features(views.enriched(spark, small), "ride_id", ordered=False)
    data = M.chronological_split(rows, datetime(2024, 1, 31), 1, days_per_month=10).cache()
    first, second = (M.search(data, 2, SPACE) for _ in range(2))
    data.unpersist()
    assert [t["params"] for t in first] == [t["params"] for t in second]
    assert [t["rmse"] for t in first] == pytest.approx([t["rmse"] for t in second])
    assert first[0]["rmse"] <= first[1]["rmse"]


def test_an_empty_window_fails_before_any_fit(spark, small, tmp_path, monkeypatch):
    monkeypatch.setattr("demand_engine.plans.train.boost", None)  # a fit would raise another error
    with pytest.raises(ValueError, match="test_rows is 0"):
        train(views.enriched(spark, small), str(tmp_path / "m"), str(tmp_path / "r"), datetime(2030, 1, 1), days_per_month=10)


def test_metrics_of_equal_labels_and_a_broken_log(spark, tmp_path):
    def r2(rows):
        return M.regression_metrics(spark.createDataFrame(rows, "label double, prediction double")).first()["r2"]

    assert r2([(2.0, 2.0), (2.0, 2.0)]) == 1.0 and r2([(2.0, 1.0), (2.0, 2.0)]) == 0.0
    (tmp_path / "runs").mkdir()
    (tmp_path / "runs" / "part-0.parquet").write_bytes(b"no parquet")
    assert M.best_parameters(load_runs(spark, str(tmp_path / "runs"))) is None
    with pytest.raises(ValueError, match="deeper"):
        M.gbt_settings({"max_depth": 31})


def test_the_first_trip_does_not_depend_on_the_order_of_rows(spark):
    noon = datetime(2024, 1, 5, 12)
    rows = [(noon if k % 3 else noon.replace(minute=1), "a", float(k), 1.0, k, *([float(k)] * 6)) for k in range(60)]
    schema = "started_at timestamp_ntz, start_station_name string, start_lat double, start_lng double, start_station_total_docks int, " + ", ".join(f"{c} double" for c in WEATHER_FILLS)
    seen = set()
    for seed in range(4):
        shuffled = spark.createDataFrame(random.Random(seed).sample(rows, 60), schema).repartition(seed + 1)
        seen |= {tuple(r) for r in station_hours(shuffled).collect()}
    assert len(seen) == 1 and next(iter(seen))[2] == 60


@pytest.mark.parametrize(("master", "local"), [("local", True), ("local[8]", True), ("local-cluster[3,2,1000]", False), ("yarn", False), ("spark://h:7077", False)])
def test_only_local_runs_may_use_a_local_folder(master, local):
    class Unset:
        conf = type("C", (), {"get": staticmethod(lambda key, default: default)})
        sparkContext = type("S", (), {"master": master, "getCheckpointDir": staticmethod(lambda: None), "setCheckpointDir": staticmethod(lambda path: None)})

    if local:
        assert shared_dir(Unset)
    else:
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(Unset)


TRIP_CSV = (
    "tripduration,starttime,stoptime,start station name,start station latitude,"
    "start station longitude,end station name,bikeid,usertype,gender\n"
)


def test_prepare_from_raw_files_to_a_report(spark, tmp_path):
    source, work = tmp_path / "source", str(tmp_path / "work")
    source.mkdir()
    rows = [
        f"60,2018-01-0{d} 0{h}:10:00,2018-01-0{d} 0{h}:40:00,Main Street,42.1,-71.1,Side St.,{d}{h},subscriber,1"
        for d in (1, 2, 3) for h in (1, 1, 2)
    ]
    with zipfile.ZipFile(source / "2018.zip", "w") as z:
        z.writestr("2018-trips.csv", TRIP_CSV + "\n".join(rows) + "\n")
    (source / "new-trips.csv").write_text(
        "started_at,ended_at,start_station_name,bike_id\n2024-05-01 10:00:00.25,2024-05-01 10:05:00,Nowhere,9\n"
    )
    for prefix, suffix, version in (
        ("A", "_Stations_2011_2016", 0), ("previous_A", "_Stations_as_of_July_2017", 1),
        ("A", "_Stations_as_of_July_2017", 2),
    ):
        (source / f"{prefix}{suffix}.csv").write_text(
            f"Name,Total docks,District,Public\nMain Street,{10 + version},Boston,Yes\nSide St.,{20 + version},Boston,Yes\n"
        )

    lists = exact_files(["A_Stations_2011_2016.csv", "previous_A_Stations_as_of_July_2017.csv", "A_Stations_as_of_July_2017.csv"])

    def observations(start, end):
        hours = spark.range(0, 24 * 2400).select(
            (F.lit(datetime(2018, 1, 1)).cast("timestamp_ntz")
             + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("time"),
            (F.col("id") % 20).cast("double").alias("temp"),
            F.lit(50.0).alias("rhum"), F.lit(3.0).alias("wspd"), F.lit(90.0).alias("wdir"),
        )
        return clamped(hours, start, end)

    path = prepare(spark, str(source), work, observations, lists)
    assert prepare(spark, str(source), work, observations, lists) == path
    trips = read_dated(spark, path)
    assert trips.count() == 10
    assert not [d for d in os.listdir(shared_dir(spark)) if d.startswith(("prepare-", "train-"))]
    old = trips.where("bike_id <> '9'").collect()
    assert {(r["start_station_name"], r["end_station_name"]) for r in old} == {("main st", "side st")}
    assert {(r["start_station_total_docks"], r["end_station_total_docks"]) for r in old} == {(11, 21)}
    assert {(r["user_type"], r["gender"]) for r in old} == {("member", "male")}
    new = trips.where("bike_id = '9'").first()
    assert new["start_station_name"] == "Nowhere" and new["start_station_version"] == 2
    assert new["start_station_total_docks"] is None and new["temp"] is not None
    assert trips.where(hour_of(F.col("started_at")).isNull()).count() == 0

    features = demand_features(trips, "started_at")
    assert [r["demand"] for r in features.collect()] == [2, 1, 2, 1, 2, 1]
    def score(f):
        return f.withColumn("prediction", F.lit(1.4))

    paths = write_report(spark, trips, score, *whole_days(datetime(2018, 1, 2), datetime(2018, 1, 3)), work)
    assert [load_table(spark, p).count() for p in paths] == [4, 26, 4, 4]
    report = prediction_report(trips, score, *whole_days(datetime(2018, 1, 2), datetime(2018, 1, 2)))
    assert [(r["actual"], r["predicted"], r["error"]) for r in report.collect()] == [(2, 1, 1), (1, 1, 0)]
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "started_date" in plan.split("PartitionFilters: ", 1)[1].split("]")[0]

    first = current_state(spark, path)
    moved = source / "new-trips.csv"
    moved.write_text("started_at,ended_at,start_station_name,bike_id\n2018-01-02 10:00:00,2018-01-02 10:05:00,Nowhere,9\n")
    os.utime(moved, (0, 10**9))
    prepare(spark, str(source), work, observations, lists)
    second = current_state(spark, path)
    assert second.number == first.number + 1 and set(second.dates) == {"2018-01-01", "2018-01-02", "2018-01-03"}
    assert {d for d, label in second.dates.items() if first.dates[d] != label} == {"2018-01-02"}
    assert trips.count() == 10  # who began to read before goes on with what was there
    again = read_dated(spark, path)
    assert again.count() == 10 and again.where("started_date = '2018-01-02'").count() == 4


def _trip(day, file, bike):
    started = datetime(2024, 3, day, 9) if day else None
    return (started, started, "A", "B", 0, 0, "member", bike, file)


def test_only_touched_dates_are_made_again(spark, tmp_path):
    schema = (
        "started_at timestamp_ntz, ended_at timestamp_ntz, start_station_name string, end_station_name string, "
        "start_station_version int, end_station_version int, user_type string, bike_id string, source_file string"
    )
    stations = spark.createDataFrame([("A", 5, 0, "yes", "x")], "station_name string, total_docks bigint, station_version int, public string, district string")
    table = str(tmp_path / "dated")

    def run(rows, warm=0, files=None, docks=stations):
        weather = spark.createDataFrame([(datetime(2024, 3, d, 9), float(d + (warm if d == 5 else 0))) for d in range(1, 9)], "time timestamp_ntz, temp double")
        times = files or {name: 1 for *_, name in rows}
        refresh(spark.createDataFrame(rows, schema), docks, weather, VERSION_DATES, table, times)
        return current_state(spark, table)

    def bikes():
        return sorted((str(r["started_date"]), r["bike_id"], r["temp"]) for r in read_dated(spark, table).collect())

    one = [_trip(1, "a", "1"), _trip(2, "a", "2"), _trip(5, "b", "3"), _trip(None, "b", "4")]
    first = run(one)
    assert bikes() == [("2024-03-01", "1", 1.0), ("2024-03-02", "2", 2.0), ("2024-03-05", "3", 5.0), ("None", "4", None)]
    assert run(one).number == first.number  # nothing has changed
    two = [*one[:2], _trip(2, "c", "5")]  # b is gone, c is new
    second = run(two)
    assert second.dates["2024-03-01"] == first.dates["2024-03-01"] and second.dates["2024-03-02"] != first.dates["2024-03-02"]
    assert bikes() == [("2024-03-01", "1", 1.0), ("2024-03-02", "2", 2.0), ("2024-03-02", "5", 2.0)]
    three = [_trip(7, "a", "1"), two[2], _trip(5, "d", "6")]  # another time of a
    third = run(three, files={"a": 2, "c": 1, "d": 1})
    assert set(third.dates) == {"2024-03-02", "2024-03-05", "2024-03-07"}
    warmer = run(three, 1, {"a": 2, "c": 1, "d": 1})
    assert {d for d, label in warmer.dates.items() if third.dates[d] != label} == {"2024-03-05"} and ("2024-03-05", "6", 6.0) in bikes()
    other = run(three, 1, {"a": 2, "c": 1, "d": 1}, stations.withColumn("total_docks", F.lit(9).cast("bigint")))
    assert not set(other.dates.items()) & set(warmer.dates.items())
    folders = [p for p in (tmp_path / "dated" / "data").glob("*/*")]
    named = {(d, v) for state in (warmer, other) for d, v in state.dates.items()}
    assert {(p.parent.name.partition("=")[2], p.name.partition("=")[2]) for p in folders if any(p.iterdir())} == named


def test_a_run_that_dies_while_writing_changes_nothing(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([_trip(1, "a", "1")], "started_at timestamp_ntz, ended_at timestamp_ntz, s string, e string, v int, w int, u string, bike_id string, source_file string")
    table = str(tmp_path / "dated")
    replace_dates(rows, table, None, {"a": 1}, {}, "s")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr("demand_engine.sources.dated_trips.write_text", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            replace_dates(rows.unionByName(rows), table, {"2024-03-01"}, {"a": 2}, {}, "s")
    assert read_dated(spark, table).count() == 1 and current_state(spark, table).number == 1
    replace_dates(rows.limit(0), table, {"2024-03-01"}, {}, {}, "s")
    assert read_dated(spark, table).count() == 0


def test_a_job_folder_goes_with_its_job(spark):
    with pytest.raises(ZeroDivisionError):
        with workspace(spark, "job") as folder:
            assert cut_lineage(spark.range(3)).count() == 3 and os.path.isdir(folder)
            raise ZeroDivisionError
    assert not os.path.exists(folder)


def test_the_training_job_enriches_its_trips_once_and_reads_them_as_written(spark, small, monkeypatch):
    from demand_engine.queries import model as Q

    made, read = [], []

    def enriched(*args):
        made.append(args)
        return views.enriched(*args)

    def trained(trips, *args, **kwargs):
        read.append(trips.inputFiles())
        return train(trips, *args, **kwargs, trials=1, space=SPACE)

    monkeypatch.setattr(Q, "enriched", enriched)
    monkeypatch.setattr(Q, "train", trained)
    rows = Q.training_job(spark, small).collect()
    assert [r.run for r in sorted(rows)] == [1, 2] and all(r.metrics_agree and r.same_parameters for r in rows)
    assert len(made) == 1 and len(read) == 2 and read[0] == read[1]
    assert read[0] and not any(small in f for f in read[0])


def test_a_written_table_is_read_back_without_a_job(spark):
    df = spark.range(20).selectExpr("id", "cast(id AS string) AS name", "array(id, NULL) AS list", "id > 3 AS flag", "timestamp_ntz'2024-01-01' AS at")
    context = spark.sparkContext
    context.setJobGroup("written", "cut_lineage")
    try:
        back = cut_lineage(df)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(context.statusTracker().getJobIdsForGroup("written")) == 1
    assert back.dtypes == df.dtypes and sorted(back.collect()) == sorted(df.collect())
    assert cut_lineage(df.where("id < 0")).count() == 0
