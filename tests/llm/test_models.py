import zlib

import numpy as np
import pyarrow as pa

from demand_engine.llm import language, quality
from demand_engine.llm.models import bounded_sample
from demand_engine.llm.language import fit_language, identify, language_report, presence
from demand_engine.llm.quality import features, fit_quality, quality_report, quality_scores


def auc(good, bad):
    return np.mean([(good > b).mean() + (good == b).mean() / 2 for b in bad])


def test_pairwise_part_is_the_sum_over_pairs():
    rng = np.random.default_rng(2)
    x, w, v = rng.normal(size=(5, 7)), rng.normal(size=7), rng.normal(size=(7, 3))
    slow = [0.3 + r @ w + sum(v[i] @ v[j] * r[i] * r[j] for i in range(7) for j in range(i)) for r in x]
    assert np.allclose(quality._margin(x, 0.3, w, v), slow)


def test_features_of_odd_texts_are_finite():
    texts = pa.array(["", None, "\n\n", "é" * 100_000, "a b a b", "%$ !!"])
    rows = np.concatenate(list(features(texts, np.array([0, np.nan, 2, -5, 1e18, np.inf]))))
    assert rows.shape[0] == 6 and np.isfinite(rows).all()


def test_quality_on_the_held_out_fold(spark, small):
    docs, labels = (spark.read.parquet(f"{small.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_report(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert auc(held[held.quality == 1].score.to_numpy(), held[held.quality == 0].score.to_numpy()) > 0.97
    assert held[held.quality == 1].predicted.mean() > 0.97


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame([(1, "good words here", 15, 9), (2, None, None, 9), (2, "", 0, 9), (None, "x", 1, 9)], "doc_id bigint, text string, n_chars bigint, score int")
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert fit_quality(docs, none) is None
    assert [r.score for r in quality_scores(docs, None).collect()] == [0.5] * 4
    odd = spark.createDataFrame([(1, 1), (1, 0), (1, 1), (2, 0), (3, None), (None, 1), (4, 1)], "doc_id bigint, quality int")
    got = quality_report(docs.drop("n_chars"), odd).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert quality_report(docs.limit(0), odd).count() == 0


def test_kernel_is_the_shared_share_of_ngrams():
    x, y = (language._scaled(p) for p in np.split(np.concatenate(list(presence(pa.array(["abcab", "xabca"])))), 2))
    a, b = ({t[i : i + n] for i in range(len(t) - n + 1)} for n in (1,) for t in ("abcab", "xabca"))
    sets = [[{t[i : i + n] for i in range(len(t) - n + 1)} for t in ("abcab", "xabca")] for n in range(1, 5)]
    slow = np.mean([len(a & b) / np.sqrt(len(a) * len(b)) for a, b in sets])
    assert np.isclose((x @ y.T).item(), slow, atol=1e-6)
    assert np.isclose((x @ x.T).item(), 1, atol=1e-6)


def test_language_on_the_held_out_fold(spark, small):
    docs = spark.read.parquet(f"{small.replace('0.001', '0.01')}/documents.parquet")
    got = language_report(docs).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_a_frequent_language_is_learned_whatever_its_place_among_many(spark):
    rng = np.random.default_rng(3)
    rare = [(k, "".join(rng.choice(list("abcdefghij"), 30)), f"a{k:04d}") for k in range(2000)]
    often = [(10_000 + k, "zyx wvu " * (1 + k % 3) + "xyz", "zz") for k in range(300)]
    df = spark.createDataFrame(rare + often, "doc_id bigint, text string, lang string")
    got = identify(df, fit_language(df)).collect()
    assert {r.lang_pred for r in got if r.doc_id >= 10_000} == {"zz"}
    sample = bounded_sample(df, "doc_id", "lang", 1500, total=4000).groupBy("lang").count().toPandas()
    assert len(sample) == 2001 and sample["count"].max() <= 10
    few = bounded_sample(df, "doc_id", "lang", 1500, total=40).groupBy("lang").count().toPandas()
    assert "zz" in set(few["lang"]) and len(few) <= 40


def test_language_edge_cases(spark):
    rows = [(k, t, l, 0) for k, (t, l) in enumerate([("the thing and", "en"), ("le chat et la", "fr"), ("12 34 !?", "en"), (None, "fr"), ("", None), ("ß", None)] * 4)]
    df = spark.createDataFrame([*rows, (None, "the end", "en", 0)], "doc_id bigint, text string, lang string, lang_pred int")
    got = identify(df, fit_language(df)).collect()
    assert len(got) == 25
    by = dict(zip((r.doc_id for r in got), got))
    assert all(by[k].lang_pred == "und" and by[k].score == 0 for k in (2, 3, 4)) and by[5].lang_pred in ("en", "fr")
    assert by[0].lang_pred == "en" and by[1].lang_pred == "fr" and by[None].lang_pred == "en"
    assert {r.lang_pred for r in identify(df, None).collect()} == {"und"}
    assert fit_language(df.limit(0)) is None and identify(df.limit(0), None).count() == 0
