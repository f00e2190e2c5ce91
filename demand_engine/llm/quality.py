"""Text quality by a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j), where the pairwise part is
1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]: linear in the features, three matrix products
per batch. The only metadata used is `n_chars`; ids, languages, sources and labels never enter.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demand_engine.llm.models import bounded_sample, fit_in_one_task, remainder
from demand_engine.llm.vectors import NOT_BLANK, byte_class, lower_table, pieces, word_bounds, word_hashes

#: Labelled rows per label that the fit uses at most, about.
FIT_ROWS = 4_000
BUCKETS = 1024
RANK = 8
EPOCHS, BATCH, RATE, DECAY = 30, 256, 0.02, 1e-4

_LETTERS = byte_class((65, 90), (97, 122), (128, 255))
_SHARES = (
    byte_class((65, 90)),
    byte_class((48, 57)),
    byte_class((0x20, 0x20), (9, 13)),
    _LETTERS,
    byte_class((33, 33), (63, 63)),
    byte_class((46, 46), (44, 44), (58, 59)),
    byte_class((35, 38), (42, 43), (60, 62), (64, 64), (91, 96), (123, 126)),
    byte_class((10, 10)),
    byte_class((128, 255)),
)
STATISTICS = len(_SHARES) + 6
METADATA = 2


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of `values` in each text's stretch."""
    totals = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return totals[offsets[1:]] - totals[offsets[:-1]]


def features(text: pa.Array | pa.ChunkedArray, n_chars: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of features for stretches of texts, in order; finite for any text."""
    lower = lower_table()
    for first, data, offsets in pieces(text):
        k = len(offsets) - 1
        size = np.diff(offsets)
        x = np.zeros((k, BUCKETS + STATISTICS + METADATA), dtype=np.float32)
        starts, ends, owner = word_bounds(data, offsets, NOT_BLANK)
        words = word_hashes(lower[data], starts, ends)
        bucket = owner * BUCKETS + (words % np.uint64(BUCKETS)).astype(np.int64)
        counts = np.log1p(np.bincount(bucket, minlength=k * BUCKETS).reshape(k, BUCKETS))
        x[:, :BUCKETS] = counts / np.maximum(np.sqrt((counts**2).sum(axis=1, keepdims=True)), 1e-9)
        n = np.bincount(owner, minlength=k)
        some, all_words = np.maximum(size, 1), np.maximum(n, 1)
        cols = [_sums(c[data], offsets) / some for c in _SHARES]
        order = np.lexsort((words, owner))
        fresh = np.ones(len(words), dtype=bool)
        fresh[1:] = (words[order][1:] != words[order][:-1]) | (owner[order][1:] != owner[order][:-1])
        length = ends - starts
        plain = np.concatenate([[0], np.cumsum(_LETTERS[data], dtype=np.int64)])
        pure = (plain[ends] - plain[starts]) == length
        cols += [
            np.log1p(size) / 10,
            np.log1p(n) / 10,
            np.bincount(owner, weights=length, minlength=k) / all_words / 10,
            np.bincount(owner[order], weights=fresh, minlength=k) / all_words,
            np.bincount(owner, weights=pure, minlength=k) / all_words,
            np.bincount(owner, weights=length == 1, minlength=k) / all_words,
        ]
        told = n_chars[first : first + k]
        known = np.isfinite(told) & (told >= 0)
        cols += [np.where(known, np.log1p(np.where(known, told, 0)) / 10, 0), known.astype(np.float64)]
        x[:, BUCKETS:] = np.stack(cols, axis=1)
        yield x


def _numbers(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.cast(pa.float64()).to_numpy(zero_copy_only=False), dtype=np.float64)


def _margin(x: np.ndarray, w0: np.ndarray, w: np.ndarray, v: np.ndarray) -> np.ndarray:
    return w0 + x @ w + 0.5 * (((x @ v) ** 2).sum(axis=1) - ((x**2) @ (v**2)).sum(axis=1))


def _fit(table: pa.Table) -> bytes:
    """Adam on the logistic loss; the order of rows and the start depend on the sample only."""
    table = table.take(np.lexsort((table.column("place").to_numpy(),)))
    y = table.column("label").to_numpy().astype(np.float32)
    x = np.concatenate(list(features(table.column("text"), _numbers(table.column("n_chars")))))
    mean, std = x[:, BUCKETS:].mean(axis=0), x[:, BUCKETS:].std(axis=0) + 1e-3
    x[:, BUCKETS:] = np.clip((x[:, BUCKETS:] - mean) / std, -5, 5)
    rng = np.random.default_rng(7)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    p = [np.array(np.log(share / (1 - share)), np.float32), np.zeros(x.shape[1], np.float32), rng.normal(0, 0.02, (x.shape[1], RANK)).astype(np.float32)]
    first, second, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for epoch in range(EPOCHS):
        rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / EPOCHS))
        for rows in np.array_split(rng.permutation(len(y)), max(1, len(y) // BATCH)):
            b, t = x[rows], y[rows]
            e = (1 / (1 + np.exp(-np.clip(_margin(b, *p), -30, 30))) - t) / len(rows)
            s = b @ p[2]
            grads = [e.sum(), b.T @ e + DECAY * p[1], b.T @ (e[:, None] * s) - ((b**2).T @ e)[:, None] * p[2] + DECAY * p[2]]
            step += 1
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                p[i] = p[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    out = io.BytesIO()
    np.savez(out, w0=p[0], w=p[1], v=p[2], mean=mean, std=std)
    return out.getvalue()


def fit_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, fold: int = 3, held: int = 1) -> bytes | None:
    """A fitted model from labelled documents outside the held-out fold; None if there are none.

    Uses about `fit_rows` documents per label at most; that bounds what is broadcast. A document with several labels has their
    mean, rounded; null labels and ids are ignored.
    """
    known = labels.select(F.col("doc_id").alias("id"), "quality").where(F.col("id").isNotNull() & F.col("quality").isNotNull())
    known = known.where(remainder(F.col("id"), fold) != held).groupBy("id").agg(F.round(F.avg("quality")).cast("int").alias("label"))
    rows = bounded_sample(known, "id", "label", fit_rows)
    held_chars = F.col("n_chars") if "n_chars" in docs.columns else F.lit(None)
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text"), held_chars.cast("double").alias("n_chars"))
    sample = texts.join(F.broadcast(rows), "id").select(F.xxhash64("id", "text").alias("place"), "label", "text", "n_chars")
    return fit_in_one_task(sample, _fit)


def scorer(model: bytes | None) -> Callable[[pa.Array, np.ndarray], np.ndarray]:
    """Scores between 0 and 1 of texts with their stated lengths; 0.5 for all without a model."""
    if model is None:
        return lambda text, n_chars: np.full(len(text), 0.5)
    m = np.load(io.BytesIO(model))
    w0, w, v, mean, std = m["w0"], m["w"], m["v"], m["mean"], m["std"]

    def score(text: pa.Array, n_chars: np.ndarray) -> np.ndarray:
        out = []
        for x in features(text, n_chars):
            x[:, BUCKETS:] = np.clip((x[:, BUCKETS:] - mean) / std, -5, 5)
            out.append(1 / (1 + np.exp(-np.clip(_margin(x, w0, w, v), -30, 30))))
        return np.concatenate(out).astype(np.float64) if out else np.zeros(0)

    return score


def quality_scores(docs: DataFrame, model: bytes | None, columns: tuple[str, ...] = ("doc_id",), name: str = "score") -> DataFrame:
    """`columns` of `docs` and a score (`name`) per row, from whole texts; null and empty texts included.

    Other columns may have any name. Repeated rows give repeated rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    held_chars = F.col("n_chars") if "n_chars" in docs.columns else F.lit(None)
    slim = docs.select(*columns, F.col("text").alias("__text"), held_chars.cast("double").alias("__chars"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(shared.value)
        for batch in batches:
            found = pa.array(score(batch.column("__text"), _numbers(batch.column("__chars"))), pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), found], [*columns, name])

    schema = slim.select(*columns).schema.add(name, "double")
    return slim.mapInArrow(run, schema)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) per document, by a model fitted here."""
    scored = quality_scores(docs, fit_quality(docs, labels))
    held = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
