"""Mixing: targets against resharing round by round, draws, emitted copies, odd rows, plans without Python."""

import math
from fractions import Fraction

import pytest
from demand_engine.llm.mixing import mix, mix_plan, mix_report
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, source string, text string, copy string, size string, target int"


def frame(spark, rows):
    return spark.createDataFrame([(i, s, t, "c", "z", 0) for i, s, t in rows], SCHEMA)


def reshared(sizes, weights=(3, 1, 2), share=Fraction(3, 2), most=2):
    """Targets by the rule as it is told: share by weight, cut at the limit, share the rest again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, Fraction(0)), share * sum(sizes.values()), set(names)
    while left and open_:
        whole = sum(weight[s] for s in open_)
        given = {s: left * weight[s] / whole for s in open_}
        left = Fraction(0)
        for s, x in given.items():
            target[s] += x
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = Fraction(most * sizes[s])
                open_.discard(s)
    return {s: float(x) for s, x in target.items()}


CASES = [
    {"a": 100, "b": 100, "c": 100},
    {"a": 1, "b": 1000, "c": 5, "d": 70, None: 30, "é": 400, "z": 0},
    {"only": 9},
    {None: 4, "\U0001f600": 3, "￿": 2, "Z": 6},
    {f"s{k}": (k * 37) % 91 for k in range(60)},
    {"none": 0, "nothing": 0},
]


@pytest.mark.parametrize("sizes", CASES)
def test_targets_equal_resharing(spark, sizes):
    rows = [(k, s, "w " * n) for k, (s, n) in enumerate(sizes.items())]
    got = {r.source: r.target for r in mix_plan(frame(spark, rows)).collect()}
    want = reshared(sizes)
    assert got.keys() == want.keys()
    assert all(got[s] == pytest.approx(want[s], rel=1e-12) for s in want)


def test_each_document_floor_or_ceiling_of_its_rate_and_near_the_target(spark):
    rows = [(k, f"s{k % 3}" if k % 10 else None, "word " * (k % 17)) for k in range(6000)]
    out = mix_report(frame(spark, rows)).collect()
    assert sorted(r.doc_id for r in out) == list(range(6000))
    for r in out:
        rate = r.target / r.source_size
        assert r.size == r.doc_id % 17 and r.taken in (r.size * math.floor(rate), r.size * math.ceil(rate)) and r.taken <= 2 * r.size
    of = {k: s for k, s, _ in rows}
    for source, target in {(of[r.doc_id], r.target) for r in out}:
        assert sum(r.taken for r in out if of[r.doc_id] == source) == pytest.approx(target, rel=0.1)
    assert mix_report(frame(spark, rows)).exceptAll(mix_report(frame(spark, rows).repartition(5))).isEmpty()


def test_other_seeds_other_draws(spark):
    docs = frame(spark, [(k, "abc"[k % 3], "one two") for k in range(400)])
    one, two = ({r.doc_id: r.copies for r in mix_plan(docs, seed=s).collect()} for s in ("mix", "other"))
    assert one != two and abs(sum(one.values()) - sum(two.values())) < 100


def test_emitted_rows_are_the_plan(spark):
    docs = frame(spark, [(1, "a", "x y"), (1, "a", "x y"), (None, None, None), (2, "b", ""), (3, "b", "z " * 40), (None, "a", " \t\n")])
    plan = {(r.doc_id, r.source): r.copies for r in mix_plan(docs).collect()}
    emitted = mix(docs)
    assert emitted.columns == ["doc_id", "source", "text", "size", "target", "copy"]
    counted = {(r.doc_id, r.source): r["count"] for r in emitted.groupBy("doc_id", "source").count().collect()}
    assert counted.get((1, "a"), 0) == 2 * plan[1, "a"] and all(counted.get(k, 0) == plan[k] for k in plan if k != (1, "a"))
    assert {r.copy for r in emitted.collect()} <= {1, 2}


def test_empty_tables_and_plans(spark):
    docs = frame(spark, [(1, "a", "x")])
    assert mix_report(docs.limit(0)).count() == 0 and mix(docs.limit(0)).count() == 0
    for df in (mix_report(docs), mix(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))
    assert mix_report(docs).agg(F.sum("taken")).first()[0] in (1, 2)
