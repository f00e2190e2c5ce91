"""Whitening: against a dense eigensolver, hard spectra, odd rows."""

import math

import demand_engine.llm.whitening as W
import numpy as np
import pytest

SCHEMA = "vec_id bigint, embedding array<float>, id int, x string, whitened int"


def spectrum(values, seed=3):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    return q @ np.diag(values) @ q.T


HARD = {
    "rank 10": np.r_[np.arange(10, 0, -1.0), np.zeros(54)],
    "equal": np.ones(64),
    "two levels": np.r_[np.full(20, 5.0), np.full(80, 1.0)],
    "halving": 2.0 ** -np.arange(100),
    "power law": 1 / np.arange(1.0, 401),
    "two giants": np.r_[1e6, 1e3, np.linspace(2, 1, 254)],
    "close": np.linspace(1.001, 1, 300),
    "narrow": np.arange(1.0, 6),
}


@pytest.mark.parametrize("name", HARD)
def test_components_of_hard_spectra(name):
    v = spectrum(HARD[name])
    values, vectors = W.leading_components(lambda q: v @ q, len(v))
    want = np.sort(HARD[name])[::-1][: W.COMPONENTS]
    assert np.abs(values - want).max() <= 1e-13 * want[0] * len(v)
    assert np.linalg.norm(v @ vectors - vectors * values, axis=0).max() <= 1e-11 * want[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(want))).max() < 1e-13


def test_no_certificate_is_an_error(monkeypatch):
    monkeypatch.setattr(W, "FILTERS", 1)
    v = spectrum(np.linspace(1.0, 0, 80))
    with pytest.raises(RuntimeError):
        W.leading_components(lambda q: v @ q, 80)


def expected(vectors):
    x = np.floor(64 * np.asarray(vectors, dtype=float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    off = x * n - sums
    covariance = (off / n).T @ (off / n) / n
    values, basis = np.linalg.eigh(covariance)
    return (off**2).sum(axis=1), off / n @ basis[:, ::-1] / np.sqrt(np.maximum(values[::-1], 1e-300)), values[::-1] / np.trace(covariance)


def compare(got, ids, vectors, components):
    deviation, white, explained = expected(vectors)
    at = {(r.vec_id, r.component): r for r in got}
    assert len(at) == len(got) == len(ids) * components
    for k in range(components):
        ours = np.array([at[i, k + 1].whitened for i in ids])
        sign = np.sign(ours @ white[:, k])
        assert np.abs(ours - sign * white[:, k]).max() < 1e-8
        assert all(at[i, k + 1].deviation == d and at[i, k + 1].n == len(ids) for i, d in zip(ids, deviation))
        assert at[ids[0], k + 1].explained == pytest.approx(explained[k], rel=1e-9)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10


def test_registered_query_against_dense_solver(spark, small):
    rows = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    got = W.whitening_report(spark.read.parquet(f"{small}/embeddings.parquet")).collect()
    compare(got, [r.vec_id for r in rows], [r.embedding for r in rows], 32)


def test_odd_rows_are_dropped_and_few_dimensions_are_enough(spark):
    rng = np.random.default_rng(5)
    good = [(k, [float(np.float32(c)) for c in rng.normal(0, 3, 5) * (1, 2, 3, 4, 5)]) for k in range(60)]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0, 4.0]), (103, [math.nan] * 5), (104, [math.inf, 0.0, 0.0, 0.0, 0.0]), (105, [-math.inf, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in good + bad], SCHEMA)
    got = W.whitening_report(df).collect()
    compare(got, [i for i, _ in good], [v for _, v in good], 5)
    assert W.whitening_report(df, 2).count() == 120


def test_repeats_null_ids_constant_dimensions(spark):
    rows = [(None, [1.0, 5.0, 2.0]), (None, [1.0, 5.0, 2.0]), (1, [3.0, 5.0, 6.0]), (1, [3.0, 5.0, 6.0])]
    df = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA)
    got = W.whitening_report(df).collect()
    assert len(got) == 4 and {r.component for r in got} == {1}
    assert all(abs(abs(r.whitened) - 1) < 1e-12 and r.explained == pytest.approx(1) for r in got)


def test_no_rows_no_variance_and_unequal_lengths(spark):
    def report(*vectors):
        return W.whitening_report(spark.createDataFrame([(k, v, 1, "x", 2) for k, v in enumerate(vectors)], SCHEMA))

    assert report(None).count() == 0 and report([1.0, 2.0]).count() == 0 and report([1.0], [1.0]).count() == 0
    with pytest.raises(ValueError, match="entries"):
        report([1.0], [1.0, 2.0])


def test_whitened_vectors_keep_their_row(spark):
    rows = [(k, [float(k % 3), float(k % 5)]) for k in range(30)]
    ints = W.integer_vectors(spark.createDataFrame(rows, "name bigint, v array<double>"), "name", "v")
    fitted = W.fit_whitening(ints)
    held = {r.id: r for r in W.whiten(ints, fitted).collect()}
    assert len(held) == 30 and held[0].whitened == held[15].whitened != held[1].whitened
    assert W.integer_vectors(spark.createDataFrame(rows, "name bigint, v array<double>"), "name", "v").first().x == [1_000_000, 1_000_000]
