"""Boosted trees against plain boosting row by row; shared passes, stopping, odd rows, saving."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import demand_engine.operators.boosting as B

COLUMNS = ("a", "b", "c", "same")


def rows(n=600, seed=1):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        a, b, c = rng.randint(0, 9), rng.random(), rng.choice([True, False])
        out.append((float(a), b, c, 7, float(a % 3) + 2 * (b > 0.4) + rng.random(), rng.random() < 0.3))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "a double, b double, c boolean, same int, demand double, held boolean")


def plain(data, settings, rounds):
    """(errors per round, predictions) by the same rules, every cut tried over all rows."""
    x = np.array([[float(v) for v in r[:4]] for r in data])
    y, held = np.array([r[4] for r in data]), np.array([r[5] for r in data])
    edges = []
    for column in x[~held].T:
        order = np.sort(column)
        part = [int(np.searchsorted(order, v, "left")) * B.BINS // len(order) for v in np.unique(column)]
        values = np.unique(column)
        edges.append([v for v, p, q in zip(values[1:], part[1:], part) if p != q])
    guess = np.full(len(y), y[~held].mean())
    errors = [math.sqrt(((y - guess)[held] ** 2).mean())]

    def weight(r):
        return np.sign(r.sum()) * max(abs(r.sum()) - settings.reg_alpha, 0) / (len(r) + settings.reg_lambda)

    def score(r):
        return max(abs(r.sum()) - settings.reg_alpha, 0) ** 2 / (len(r) + settings.reg_lambda)

    for _ in range(rounds):
        residual, nodes, leaves, add = y - guess, [np.ones(len(y), dtype=bool)], 1, np.zeros(len(y))
        for _ in range(settings.max_depth):
            found = []
            for place, node in enumerate(nodes):
                fit, best = node & ~held, (B.LEAST_GAIN, None)
                for k, own in enumerate(edges):
                    for e in own:
                        left, right = fit & (x[:, k] < e), fit & (x[:, k] >= e)
                        if min(left.sum(), right.sum()) >= settings.min_child_samples:
                            gain = score(residual[left]) + score(residual[right]) - score(residual[fit])
                            if gain > best[0] + 1e-9:
                                best = (gain, (k, e))
                if best[1]:
                    found.append((-best[0], place, *best[1]))
            children = []
            for _, place, k, e in sorted(found):
                if leaves == settings.num_leaves:
                    break
                for side in (nodes[place] & (x[:, k] < e), nodes[place] & (x[:, k] >= e)):
                    add[side] = settings.learning_rate * weight(residual[side & ~held])
                    children.append(side)
                leaves += 1
            nodes = children if leaves < settings.num_leaves else []
        guess = guess + add
        errors.append(math.sqrt(((y - guess)[held] ** 2).mean()))
    return errors, guess


PARAMS = [
    {"max_depth": 3, "num_leaves": 31, "n_estimators": 12, "min_child_samples": 5, "learning_rate": 0.3},
    {"max_depth": 6, "num_leaves": 5, "n_estimators": 9, "min_child_samples": 20, "reg_alpha": 3.0, "reg_lambda": 5.0},
    {"max_depth": 1, "n_estimators": 20, "learning_rate": 0.5, "reg_lambda": 0.5},
]


@pytest.mark.parametrize("tasks", [1, 3])
def test_all_sets_equal_plain_boosting(spark, monkeypatch, tasks):
    data = rows()
    monkeypatch.setattr(B, "WRITE_EVERY", 5)
    if tasks > 1:
        monkeypatch.setattr(B, "TASK_ROWS", 200)
        monkeypatch.setattr(B, "NODES", 2)
    models = B.boost(frame(spark, data).repartition(4), PARAMS, "held", columns=COLUMNS)
    for params, model in zip(PARAMS, models):
        errors, guess = plain(data, B.Settings.of(params), params["n_estimators"])
        assert model.errors == pytest.approx(errors, rel=1e-9)
        assert model.rounds == B.best_round(errors)
        by_round = model.predictions_by_round(frame(spark, data)).collect()
        assert [r.prediction[-1] for r in by_round] == pytest.approx(list(guess), rel=1e-9)
        assert [r.prediction for r in model.transform(frame(spark, data)).collect()] == pytest.approx([r.prediction[model.rounds] for r in by_round])


def test_a_set_is_not_changed_by_its_neighbours(spark):
    df, drawn = frame(spark, rows()), {"subsample": 0.6, "colsample_bytree": 0.5, "n_estimators": 7, "max_depth": 4}
    [alone] = B.boost(df, [drawn], "held", columns=COLUMNS)
    first, _ = B.boost(df, [drawn, {"n_estimators": 30}], "held", columns=COLUMNS)
    assert alone.errors == pytest.approx(first.errors) and [t.feature for t in alone.trees] == [t.feature for t in first.trees]


def test_samples_take_their_share():
    x = np.array([(i, j, k) for i in range(20) for j in range(20) for k in range(20)], dtype=np.int8)
    kept = B._kept_rows(x, 0.7, "42:1:1")
    assert abs(kept.mean() - 0.7) < 0.03 and (kept != B._kept_rows(x, 0.7, "42:1:2")).mean() > 0.2
    assert B._kept_rows(x, 1.0, "any").all()


def test_boosting_ends_patience_rounds_after_the_least_error(spark):
    [model] = B.boost(frame(spark, rows()), [{"n_estimators": 500, "learning_rate": 0.4}], "held", patience=6, columns=COLUMNS)
    assert len(model.errors) - 1 == model.rounds + 6 < 500
    assert model.rmse == min(model.errors[1:]) and len(model.trees) == model.rounds + 6
    assert B.best_round([1.0]) == 0 and B.best_round([1.0, 2.0, 2.0]) == 1 and B.best_round([3.0, 2.0, 1.0]) == 2


def test_without_held_out_rows_all_rounds_count(spark):
    [model] = B.boost(frame(spark, rows(200)), [{"n_estimators": 4}], columns=COLUMNS)
    assert model.rounds == len(model.trees) == 4 and model.errors == []


def test_constant_labels_repeated_rows_and_missing_labels(spark):
    data = [(1.0, 1.0, True, 1, 2.0, False)] * 50 + [(2.0, 1.0, True, 1, 2.0, True)] * 3 + [(3.0, 1.0, True, 1, None, False)]
    [model] = B.boost(frame(spark, data), [{"n_estimators": 3}], "held", columns=COLUMNS)
    assert model.errors == [0.0] * 4 and model.base == 2.0
    assert {r.prediction for r in model.transform(frame(spark, data)).collect()} == {2.0}
    assert model.transform(frame(spark, data).limit(0)).count() == 0


def test_nothing_to_fit_or_validate_on_is_an_error(spark):
    df = frame(spark, rows(50))
    for part in ("held", "NOT held"):
        with pytest.raises(ValueError, match="validate"):
            B.boost(df.where(part), [{}], "held", columns=COLUMNS)
    with pytest.raises(ValueError, match="unknown"):
        B.boost(df, [{"leafs": 3}], "held", columns=COLUMNS)
    with pytest.raises(Exception):
        B.boost(df.withColumn("a", F.lit(None).cast("double")), [{}], "held", columns=COLUMNS)


def test_models_come_back_as_saved(spark, tmp_path):
    df = frame(spark, rows(300)).withColumns({"x": F.lit("clash"), "label": F.lit(0)})
    [model] = B.boost(df, [{"n_estimators": 30, "learning_rate": 0.5}], "held", patience=3, columns=COLUMNS)
    path = B.save_boosted(spark, model, str(tmp_path / "m"))
    again = B.load_boosted(spark, path)
    assert len(again.trees) == model.rounds < len(model.trees)
    assert [tuple(r) for r in model.transform(df).collect()] == [tuple(r) for r in again.transform(df).collect()]
    assert model.transform(df).columns == [*df.columns, "prediction"]


def test_a_slow_rate_keeps_many_rounds(spark):
    df = frame(spark, [(float(k % 10), k % 7 / 7, k % 2 == 0, 1, float(3 * (k % 10) + k % 7), k % 5 == 0) for k in range(700)])
    [model] = B.boost(df, [{"max_depth": 2, "learning_rate": 0.05, "n_estimators": 30}], "held", patience=5, columns=COLUMNS)
    assert model.rounds == 30 and model.rmse < model.errors[0] / 2


def test_a_small_table_takes_few_jobs_and_grows_the_same_trees(spark, monkeypatch):
    df = frame(spark, rows()).repartition(3)
    params = [
        {"n_estimators": 25, "max_depth": 5, "subsample": 0.7, "colsample_bytree": 0.5, "learning_rate": 0.2},
        {"n_estimators": 12, "num_leaves": 6, "min_child_samples": 40, "reg_alpha": 2.0, "reg_lambda": 1.0},
    ]
    context = spark.sparkContext
    context.setJobGroup("few-jobs", "boosting")
    try:
        grown = B.boost(df, params, "held", columns=COLUMNS)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(context.statusTracker().getJobIdsForGroup("few-jobs")) < 25  # passes take one per level and round at least
    bare = B.boost(df, params, "held", columns=COLUMNS, keep_trees=False)
    monkeypatch.setattr(B, "TASK_ROWS", 200)
    for one, two, errors_only in zip(grown, B.boost(df, params, "held", columns=COLUMNS), bare):
        assert one.rounds == two.rounds == errors_only.rounds and errors_only.trees == []
        assert one.errors == pytest.approx(two.errors, rel=1e-9) and errors_only.errors == one.errors
        for a, b in zip(one.trees, two.trees, strict=True):
            assert (a.feature, a.cut, a.left) == (b.feature, b.cut, b.left) and a.value == pytest.approx(b.value, rel=1e-9, abs=1e-12)


def test_a_fit_without_held_out_rows_takes_few_jobs_too(spark):
    context = spark.sparkContext
    context.setJobGroup("one-fit", "boosting")
    try:
        [model] = B.boost(frame(spark, rows(300)), [{"n_estimators": 40, "max_depth": 3, "learning_rate": 0.2}], columns=COLUMNS)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(model.trees) == 40 and len(context.statusTracker().getJobIdsForGroup("one-fit")) < 25


def test_a_small_table_is_written_once(spark, monkeypatch):
    written, write = [], B.cut_lineage
    monkeypatch.setattr(B, "cut_lineage", lambda df: written.append(df) or write(df))
    B.boost(frame(spark, rows(200)), [{"n_estimators": 2}], columns=COLUMNS)
    assert len(written) == 1


def test_rows_reach_the_leaves_that_a_walk_finds():
    rng, tree = random.Random(3), B.Tree()
    tree.add(0.0)
    for node in range(40):  # a deep and uneven tree: some nodes stay leaves
        if node < len(tree.value) and (node == 0 or rng.random() < 0.7):
            tree.feature[node], tree.cut[node] = rng.randrange(3), rng.randrange(B.BINS - 1)
            tree.left[node] = tree.add(rng.random())
            tree.add(rng.random())
    x = np.random.default_rng(4).integers(0, B.BINS, (500, 3)).astype(np.int8)

    def walk(row):
        node = 0
        while tree.feature[node] >= 0:
            node = tree.left[node] + int(row[tree.feature[node]] > tree.cut[node])
        return node

    assert tree.leaf_of(x).tolist() == [walk(r) for r in x]
    assert tree.predict(x).tolist() == [tree.value[walk(r)] for r in x]
    assert B.Tree([-1], [0], [0], [2.5]).predict(x[:4]).tolist() == [2.5] * 4 and len(tree.predict(x[:0])) == 0
