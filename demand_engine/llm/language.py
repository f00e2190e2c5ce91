"""Language identification by a string kernel with Nystroem landmarks and kernel ridge regression.

The kernel is a blended spectrum of presence: for n = 1 to 4, the share of n-grams that two texts
both have, |G_n(x) & G_n(y)| / sqrt(|G_n(x)| |G_n(y)|), averaged over n. N-grams are those of the
UTF-8 bytes, A-Z in lower case and all other ASCII characters as blanks, hashed to fixed ranges. A
text is seen through its kernel values with a few landmark texts; one ridge regression per language
is fitted on the Nystroem features of those, and texts are scored by matrix products per batch.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demand_engine.llm.models import bounded_sample, fit_in_one_task, remainder
from demand_engine.llm.vectors import byte_class, lower_table, pieces

#: Documents per language that the fit uses at most, about; landmarks among them.
FIT_ROWS = 1_500
LANDMARKS = 160
RIDGE = 1e-3
#: Hash range of the n-grams for n = 1, 2, ...
RANGES = (256, 2048, 4096, 4096)
UNKNOWN = "und"

_PIECE = 1 << 20
_ROWS = 256
_EDGES = np.concatenate([[0], np.cumsum(RANGES)])


def _folded() -> np.ndarray:
    table = lower_table()
    table[~byte_class((65, 90), (97, 122), (128, 255))] = 32
    return table


def presence(text: pa.Array | pa.ChunkedArray) -> Iterator[np.ndarray]:
    """Rows of n-gram presence for stretches of texts, in order."""
    table, width = _folded(), int(_EDGES[-1])
    for _, data, offsets in pieces(text, _PIECE):
        data = table[data].astype(np.uint32)
        for low in range(0, len(offsets) - 1, _ROWS):
            bounds = offsets[low : low + _ROWS + 1]
            part = data[bounds[0] : bounds[-1]]
            bounds = bounds - bounds[0]
            x = np.zeros((len(bounds) - 1, width), dtype=np.float32)
            flat = x.reshape(-1)
            row = np.repeat(np.arange(len(bounds) - 1, dtype=np.int64) * width, np.diff(bounds))
            left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(part))
            code = np.zeros(len(part), dtype=np.uint32)
            for n, size in enumerate(RANGES, 1):
                if len(part) < n:
                    break
                code = code[: len(part) - n + 1] * np.uint32(0x01000193) + part[n - 1 :] + np.uint32(1)
                place = code if n == 1 else (code ^ (code >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(8)
                whole = left[: len(code)] >= n
                flat[row[: len(code)][whole] + _EDGES[n - 1] + (place[whole] % np.uint32(size))] = 1
            yield x


def _scaled(x: np.ndarray) -> np.ndarray:
    """Presence rows scaled so that a dot product of two is their kernel value."""
    x = x.copy()
    for n in range(len(RANGES)):
        part = x[:, _EDGES[n] : _EDGES[n + 1]]
        part /= np.sqrt(np.maximum(part.sum(axis=1, keepdims=True), 1) * len(RANGES))
    return x


def _fit(table: pa.Table) -> bytes:
    table = table.take(np.argsort(table.column("place").to_numpy(), kind="stable"))
    langs = np.array(table.column("label").to_pylist(), dtype=object)
    names = sorted(set(langs))
    turn = {name: 0 for name in names}
    order = []
    for name in langs:  # the first documents of each language in turn
        order.append(turn[name])
        turn[name] += 1
    picked = np.lexsort((langs.astype(str), order))[:LANDMARKS]
    marks = np.concatenate([_scaled(x) for x in presence(table.column("text").take(pa.array(picked)))])
    kernel = np.concatenate([_scaled(x) @ marks.T for x in presence(table.column("text"))]).astype(np.float64)
    values, vectors = np.linalg.eigh(kernel[picked])
    kept = values > 1e-6 * values.max()
    project = vectors[:, kept] / np.sqrt(values[kept])
    phi = np.concatenate([kernel @ project, np.ones((len(langs), 1))], axis=1)
    target = np.where(langs[:, None] == np.array(names, dtype=object)[None, :], 1.0, -1.0)
    share = (target > 0).mean(axis=0)
    weight = np.array([1 / (len(names) * share[names.index(v)]) for v in langs])
    gram = phi.T @ (phi * weight[:, None]) + RIDGE * len(langs) * np.eye(phi.shape[1]) / phi.shape[1]
    solved = np.linalg.solve(gram, phi.T @ (target * weight[:, None]))
    out = io.BytesIO()
    np.savez_compressed(out, marks=marks.astype(np.float16), weights=project @ solved[:-1], bias=solved[-1], names=json.dumps(names))
    return out.getvalue()


def fit_language(docs: DataFrame, fit_rows: int = FIT_ROWS, fold: int = 5, held: int = 0) -> bytes | None:
    """A fitted model from documents with a language outside the held-out fold; None if there are none.

    Uses about `fit_rows` documents per language at most, and only those with a letter.
    """
    rows = docs.select(F.col("doc_id").alias("id"), F.col("text"), F.col("lang").alias("label"))
    rows = rows.where(F.col("label").isNotNull() & F.col("text").rlike(r"\p{L}") & (remainder(F.col("id"), fold) != held))
    sample = bounded_sample(rows, "id", "label", fit_rows)
    return fit_in_one_task(sample.select(F.xxhash64("id", "text").alias("place"), "label", "text"), _fit)


def identify(docs: DataFrame, model: bytes | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) per row: the language of the whole text.

    `und` with score 0 for a null text or one without a letter, and for all without a model. Other
    columns are ignored; repeated rows give repeated rows. Ties go to the first language in order.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if shared.value is not None:
            m = np.load(io.BytesIO(shared.value))
            marks, weights, bias = m["marks"].astype(np.float32), m["weights"], m["bias"]
            names = json.loads(str(m["names"]))
        for batch in batches:
            text = batch.column("text")
            lettered = np.array([any(map(str.isalpha, t.as_py() or "")) for t in text], dtype=bool)
            langs, scores = np.full(len(batch), UNKNOWN, dtype=object), np.zeros(len(batch))
            if shared.value is not None and lettered.any():
                margins = np.concatenate([(_scaled(x) @ marks.T) @ weights + bias for x in presence(text)])
                best = margins.argmax(axis=1)
                langs[lettered] = np.array(names, dtype=object)[best[lettered]]
                scores[lettered] = np.clip((margins.max(axis=1)[lettered] + 1) / 2, 0, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs.tolist(), pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"]
            )

    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def language_report(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per document, by a model fitted here."""
    found = identify(docs, fit_language(docs))
    held = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")
