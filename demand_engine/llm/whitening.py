"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance is never formed. Its product with a narrow block, X'XQ of the centred rows, is one
distributed pass: each task multiplies its rows, the partial products are summed by dimension. A
polynomial of the covariance, applied by a three-term recurrence of such passes, damps everything
inside the interval of unwanted eigenvalues; QR and Rayleigh-Ritz turn the filtered block into
approximate eigenvectors. Converged ones are locked and kept out of the recurrence, and the iteration
goes on until the residual of each wanted one is at rounding level.

The driver holds blocks of dimensions x (components + a few); nothing there grows with the rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demand_engine.session import cut_lineage

#: An entry c counts as floor(SCALE * c) + OFFSET; components asked for.
SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 32
#: Block columns beyond the wanted ones; columns and passes of the first look at the spectrum.
GUARD, PROBE, PROBE_PASSES = 8, 4, 5
#: Most passes per filter, gain wanted from one, and most by which it may favour one column over another.
DEGREE, GAIN, CONTRAST = 16, 1e7, 1e8
#: Filters at most. Residuals that no filter of the last few has lowered are as low as rounding lets them
#: be; they are accepted below STALLED times the largest eigenvalue and below OWN times their own.
FILTERS, PATIENCE, STALLED, OWN = 80, 3, 1e-11, 1e-6
#: Components with an eigenvalue below this part of the largest carry rounding only and are left out.
RANK = 1e-13
#: Entries multiplied at once inside a task.
_ENTRIES = 1 << 20


@dataclass(frozen=True)
class Centre:
    """Rows that are fitted on and their sum per dimension, exactly."""

    n: int
    sums: np.ndarray

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exactly."""
        most = int(np.abs(x).max(initial=0)) * self.n + int(np.abs(self.sums).max(initial=0))
        if most >= 1 << 63:
            raise OverflowError(f"n * x takes more than 64 bits for {self.n} rows")
        return x * np.int64(self.n) - self.sums

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x) / float(self.n)


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, x): the rows whose vector is neither null nor empty and holds finite numbers only, in whole steps."""
    vector = F.col(f"`{vector_col}`")
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(SCALE))) + F.lit(OFFSET))
    return df.where(vector.isNotNull() & (F.size(vector) > 0) & finite).select(F.col(f"`{id_col}`").alias("id"), x.alias("x"))


def _matrices(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, rows x dims) for stretches of a batch that bound what is held beside it."""
    lists = batch.column(batch.schema.get_field_index("x"))
    entries = np.asarray(lists.flatten()).reshape(-1, dims)
    step = max(1, _ENTRIES // dims)
    for first in range(0, len(entries), step):
        yield first, entries[first : first + step]


def _by_dimension(rows: DataFrame, make: Callable[[Iterator[pa.RecordBatch]], np.ndarray], dims: int, width: int, kind: str) -> np.ndarray:
    """The sum over all tasks of what `make` returns for each, dims x width; summed by Spark, per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = make(batches)
        columns = {"dim": np.arange(dims, dtype=np.int32)} | {f"v{k}": np.ascontiguousarray(total[:, k]) for k in range(width)}
        yield pa.RecordBatch.from_pydict(columns)

    names = [f"v{k}" for k in range(width)]
    partial = rows.select("x").mapInArrow(run, "dim int, " + ", ".join(f"{c} {kind}" for c in names))
    summed = partial.groupBy("dim").agg(*(F.sum(c).alias(c) for c in names))
    out = np.zeros((dims, width), dtype=np.int64 if kind == "bigint" else np.float64)
    for row in summed.collect():
        out[row["dim"]] = row[1:]
    return out


def centre_of(rows: DataFrame) -> Centre | None:
    """The exact centre of (id, x), or None without rows. Vectors of different lengths are an error."""
    least, most, n = rows.agg(F.min(F.size("x")), F.max(F.size("x")), F.count(F.lit(1))).first()
    if not n:
        return None
    if least != most:
        raise ValueError(f"vectors have from {least} to {most} entries")

    def make(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((most, 1), dtype=np.int64)
        for batch in batches:
            for _, x in _matrices(batch, most):
                total[:, 0] += x.sum(axis=0)
        return total

    return Centre(n, _by_dimension(rows, make, most, 1, "bigint")[:, 0])


def _multiplier(rows: DataFrame, centre: Centre) -> Callable[[np.ndarray], np.ndarray]:
    """V @ block, V being the covariance of (id, x), by one pass over the rows."""
    dims = len(centre.sums)

    def multiply(block: np.ndarray) -> np.ndarray:
        def make(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            total = np.zeros(block.shape)
            for batch in batches:
                for _, x in _matrices(batch, dims):
                    c = centre.centred(x)
                    total += c.T @ (c @ block)
            return total

        return _by_dimension(rows, make, dims, block.shape[1], "double") / centre.n

    return multiply


def _trace(rows: DataFrame, centre: Centre) -> float:
    dims = len(centre.sums)

    def make(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((dims, 1))
        for batch in batches:
            for _, x in _matrices(batch, dims):
                total[:, 0] += np.square(centre.centred(x)).sum(axis=0)
        return total

    return float(_by_dimension(rows, make, dims, 1, "double").sum()) / centre.n


def _orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of `block` without its part along `against`; twice, for rounding."""
    for _ in range(2):
        block = np.linalg.qr(block - against @ (against.T @ block))[0]
    return block


def _ritz(basis: np.ndarray, image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, falling; vectors; their images) of the covariance on the span of `basis`; image = V @ basis."""
    inner = basis.T @ image
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    order = np.argsort(-values)
    return values[order], basis @ turn[:, order], image @ turn[:, order]


def _least_value(multiply: Callable[[np.ndarray], np.ndarray], dims: int, rng: np.random.Generator) -> float:
    """A bound below the spectrum, as a few block Lanczos passes see it: least Ritz value less its residual."""
    basis = image = np.zeros((dims, 0))
    block = rng.standard_normal((dims, min(PROBE, dims)))
    for _ in range(PROBE_PASSES):
        fresh = _orthonormal(block, basis)[:, : dims - basis.shape[1]]
        if not fresh.shape[1]:
            break
        block = multiply(fresh)
        basis, image = np.hstack([basis, fresh]), np.hstack([image, block])
    values, vectors, images = _ritz(basis, image)
    return max(0.0, values[-1] - float(np.linalg.norm(images[:, -1] - values[-1] * vectors[:, -1])))


def _degree(top: float, last: float) -> int:
    """Passes of a filter that raises x = `last` (> 1) by GAIN, and x = `top` by at most CONTRAST more."""
    slow, fast = math.acosh(max(last, 1 + 1e-9)), math.acosh(max(top, last, 1 + 1e-9))
    wanted = math.ceil(math.log(2 * GAIN) / slow)
    allowed = int(math.log(CONTRAST) / max(fast - slow, 1e-9))
    return max(2, min(DEGREE, wanted, allowed))


def _filtered(
    multiply: Callable[[np.ndarray], np.ndarray], block: np.ndarray, image: np.ndarray, locked: np.ndarray, low: float, cut: float, degree: int
) -> np.ndarray:
    """T_degree of the covariance, [low, cut] taken to [-1, 1], times `block`; image = V @ block."""
    middle, half = (cut + low) / 2, (cut - low) / 2
    before, now = block, (image - middle * block) / half
    for _ in range(degree - 1):
        now -= locked @ (locked.T @ now)
        before, now = now, 2 * (multiply(now) - middle * now) / half - before
    return now


def leading_components(
    multiply: Callable[[np.ndarray], np.ndarray], dims: int, wanted: int = COMPONENTS, seed: int = 7
) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; unit eigenvectors as columns) of the `wanted` largest, certified by residual.

    A block as wide as the space needs no filter: Rayleigh-Ritz is exact there. An iteration that ends
    without certificate is an error.
    """
    rng = np.random.default_rng(seed)
    wanted, width = min(wanted, dims), min(dims, wanted + GUARD)
    none = np.zeros((dims, 0))
    block = _orthonormal(rng.standard_normal((dims, width)), none)
    values, block, image = _ritz(block, multiply(block))
    low = _least_value(multiply, dims, rng) if width < dims else 0.0
    locked, kept = none, np.zeros(0)
    least, unlowered = math.inf, 0
    for _ in range(FILTERS):
        residuals = np.linalg.norm(image - block * values, axis=0)
        largest = max([*kept[:1], *values[:1]])
        certain = 8 * np.finfo(float).eps * math.sqrt(dims) * largest
        open_ = residuals[: wanted - len(kept)]
        worst = float(open_.max(initial=0.0))
        unlowered = 0 if worst < least / 2 else unlowered + 1
        least = min(least, worst)
        low_enough = np.all(open_ <= np.minimum(STALLED * largest, OWN * np.abs(values[: len(open_)])))
        stalled = unlowered >= PATIENCE and low_enough
        good = len(open_) if stalled or width == dims else int(np.argmax(np.append(open_ > certain, True)))
        if good:
            locked, kept = np.hstack([locked, block[:, :good]]), np.append(kept, values[:good])
            values, block, image = values[good:], block[:, good:], image[:, good:]
            least, unlowered = math.inf, 0
        if len(kept) == wanted:
            order = np.argsort(-kept)
            return kept[order], locked[:, order]
        low = min(low, max(0.0, float(values[-1])))
        cut = max(float(values[-1]), low + 1e-6 * float(values[0]))
        scaled = (values - (cut + low) / 2) / ((cut - low) / 2)
        degree = _degree(float(scaled[0]), float(scaled[wanted - len(kept) - 1]))
        block = _orthonormal(_filtered(multiply, block, image, locked, low, cut, degree), locked)
        values, block, image = _ritz(block, multiply(block))
    raise RuntimeError(f"no certificate after {FILTERS} filters: residual {worst:.3g}")


@dataclass(frozen=True)
class Whitening:
    """Fitted whitening: rows times `weights` (dims x components), centred, have the identity as covariance."""

    centre: Centre
    weights: np.ndarray
    explained: np.ndarray
    identity_error: float


def _identity_error(rows: DataFrame, centre: Centre, weights: np.ndarray) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, from the rows themselves."""
    dims, width = weights.shape

    def make(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((width, width))
        for batch in batches:
            for _, x in _matrices(batch, dims):
                white = centre.centred(x) @ weights
                total += white.T @ white
        return total

    covariance = _by_dimension(rows, make, width, width, "double") / centre.n
    return float(np.abs(covariance - np.eye(width)).max(initial=0.0))


def fit_whitening(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on all of (id, x), which is read once per pass and so should be written; None without rows.

    Components whose eigenvalue is nothing but rounding (constant or dependent dimensions, one row) are
    left out. The sign of a component makes its largest entry positive.
    """
    centre = centre_of(rows)
    if centre is None:
        return None
    trace = _trace(rows, centre)
    if trace == 0:
        return Whitening(centre, np.zeros((len(centre.sums), 0)), np.zeros(0), 0.0)
    values, vectors = leading_components(_multiplier(rows, centre), len(centre.sums), components)
    real = values > RANK * values[0]
    values, vectors = values[real], vectors[:, real]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    weights = vectors / np.sqrt(values)
    return Whitening(centre, weights, values / trace, _identity_error(rows, centre, weights))


def whiten(rows: DataFrame, fitted: Whitening) -> DataFrame:
    """(id, deviation, whitened): per row the exact sum of (n * x - S)^2 and the whitened vector."""
    centre, weights = fitted.centre, fitted.weights
    dims, width = weights.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, x in _matrices(batch, dims):
                off = centre.deviations(x)
                if float(np.square(off.astype(float)).sum(axis=1).max(initial=0.0)) >= 2.0**63:
                    raise OverflowError("a squared deviation takes more than 64 bits")
                white = (off / float(centre.n)) @ weights
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(first, len(x)),
                        pa.array((off * off).sum(axis=1)),
                        pa.ListArray.from_arrays(np.arange(0, white.size + 1, max(width, 1), dtype=np.int32)[: len(x) + 1] if width else np.zeros(len(x) + 1, dtype=np.int32), white.ravel()),
                    ],
                    ["id", "deviation", "whitened"],
                )

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, deviation bigint, whitened array<double>")


def whitening_report(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per remaining row and component.

    Rows whose vector is null, empty or holds a null or non-finite entry are dropped; vectors of different
    lengths are an error, as are entries and row counts whose squares take more than 64 bits. Repeated
    rows and null ids count like others. Without variance or without rows the result is empty. Other
    columns are ignored.
    """
    rows = cut_lineage(integer_vectors(embeddings))
    fitted = fit_whitening(rows, components)
    if fitted is None:
        fitted = Whitening(Centre(1, np.zeros(1, dtype=np.int64)), np.zeros((1, 0)), np.zeros(0), 0.0)
    explained = F.array(*map(F.lit, map(float, fitted.explained))).cast("array<double>")
    each = whiten(rows, fitted).select("id", "deviation", F.posexplode("whitened").alias("at", "white"))
    return each.select(
        F.col("id").alias("vec_id"), (F.col("at") + 1).alias("component"), F.lit(fitted.centre.n).cast("bigint").alias("n"),
        "deviation", F.col("white").alias("whitened"), F.get(explained, F.col("at")).alias("explained"),
        F.lit(float(fitted.identity_error)).alias("identity_error"),
    )
