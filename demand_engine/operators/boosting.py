"""Boosted regression trees, for many sets of parameters in the same passes over one binned table.

Features are cut into bins once. Rows with the same bins are one row with a count, the sum of their labels
and of the labels' squares, which is all that boosting for squared errors needs of them. What each parameter
set predicts so far is a column, its margin. One pass over the table grows one level of the current tree of
every set: tasks sum residuals by (set, node, feature, bin), Spark adds the sums up, the best cut of each node
is chosen per group, and only the cuts come to the driver. The pass that begins a round also sums the squared
errors of held-out rows, so that boosting can stop by them; no round is fitted twice.

A table of at most `TASK_ROWS` rows, as binned and aggregated by Spark, is one partition, whose sums are whole.
Passes over it would be thousands of jobs of one small task each. There the tasks share out the parameter sets
instead: one job, a task per set, which grows all rounds of its set by the same rules.

In passes the margins are written every few rounds, to the folder all executors share; until then the trees grown since
are applied on the fly. A lost task repeats one pass at most, or its set where sets are shared out.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demand_engine.operators.tables import quoted
from demand_engine.schemas import FEATURE_COLUMNS
from demand_engine.session import cut_lineage

# Bins per feature, rounds without gain that end boosting, seed.
BINS, PATIENCE, SEED = 32, 50, 42
# Rounds between two writes of the margins; rows per task at least (a smaller table is one task's); open nodes whose sums are one group.
WRITE_EVERY, TASK_ROWS, NODES = 8, 200_000, 64
# Rows that no cut can move any more are left out of sums once the others are fewer than this share.
FEW = 0.7
# A cut has to lower the squared error by more than rounding does.
LEAST_GAIN = 1e-9


@dataclass(frozen=True)
class Bins:
    """Where each feature is cut: the number of edges at or below a value is its bin."""

    columns: tuple[str, ...]
    edges: tuple[tuple[float, ...], ...]


def _number(name: str) -> Column:
    value = quoted(name).cast("double")
    return F.when(value.isNotNull() & ~F.isnan(value), value).otherwise(F.raise_error(F.lit(f"feature {name} has no value")))


def fit_bins(df: DataFrame, columns: Sequence[str] = FEATURE_COLUMNS, most: int = BINS) -> Bins:
    """Cuts at the values that begin a new `most`-th part of the rows, exactly, by one pass over the distinct values."""
    values = F.array(*map(_number, columns))
    counts = df.select(F.posexplode(values).alias("feature", "value")).groupBy("feature", "value").count()
    by_value = Window.partitionBy("feature").orderBy("value")
    below = F.coalesce(F.sum("count").over(by_value.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    part = F.floor(below * most / F.sum("count").over(Window.partitionBy("feature")))
    parts = counts.withColumn("part", part)
    begins = parts.withColumn("before", F.lag("part").over(by_value)).where("part <> before")
    edges = {r["feature"]: tuple(r["edges"]) for r in begins.groupBy("feature").agg(F.sort_array(F.collect_list("value")).alias("edges")).collect()}
    return Bins(tuple(columns), tuple(edges.get(k, ()) for k in range(len(columns))))


def with_bins(df: DataFrame, bins: Bins, out: str = "x") -> DataFrame:
    """`df` with the bins of its features as an array of tinyint. A null or NaN feature is an error."""
    cut = [k for k, edges in enumerate(bins.edges) if edges]
    rows = df.withColumns({f"__value{k}": _number(bins.columns[k]) for k in cut})
    if cut:
        rows = Bucketizer(
            splitsArray=[[-math.inf, *bins.edges[k], math.inf] for k in cut],
            inputCols=[f"__value{k}" for k in cut],
            outputCols=[f"__bin{k}" for k in cut],
            handleInvalid="error",
        ).transform(rows)
    x = F.array(*(F.col(f"__bin{k}").cast("tinyint") if k in cut else F.lit(0).cast("tinyint") for k in range(len(bins.columns))))
    return rows.withColumn(out, x).drop(*(f"__{what}{k}" for k in cut for what in ("value", "bin")))


@dataclass(frozen=True)
class Settings:
    """Parameters of a boosted model, under their usual names."""

    num_leaves: int = 31
    max_depth: int = 6
    learning_rate: float = 0.1
    n_estimators: int = 100
    min_child_samples: int = 20
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    reg_alpha: float = 0.0
    reg_lambda: float = 0.0

    @staticmethod
    def of(params: Mapping[str, object]) -> Settings:
        """Of known parameters; others are an error."""
        kinds = {name: type(default) for name, default in Settings().__dict__.items()}
        if unknown := set(params) - set(kinds):
            raise ValueError(f"unknown parameters: {', '.join(sorted(unknown))}")
        return Settings(**{name: kinds[name](value) for name, value in params.items()})


@dataclass
class Tree:
    """Nodes by number, the root 0: feature (-1: a leaf), last bin that goes left, left child (the right one follows), value."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self, value: float) -> int:
        self.feature.append(-1)
        self.cut.append(0)
        self.left.append(0)
        self.value.append(value)
        return len(self.value) - 1

    def _depth(self) -> int:
        level = [0] * len(self.feature)
        for node, feature in enumerate(self.feature):
            if feature >= 0:
                level[self.left[node]] = level[self.left[node] + 1] = level[node] + 1
        return max(level)

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The number of the leaf each row of bins ends in."""
        feature, cut, left = np.array(self.feature), np.array(self.cut), np.array(self.left)
        leaf = np.flatnonzero(feature < 0)  # leads to itself, so that all rows take as many steps
        feature[leaf], cut[leaf], left[leaf] = 0, BINS, leaf
        cut = cut.astype(np.int8)
        at, bins, first = np.zeros(len(x), dtype=np.int64), x.reshape(-1), np.arange(len(x)) * x.shape[1]
        for _ in range(self._depth()):
            at = left.take(at) + (bins.take(first + feature.take(at)) > cut.take(at))
        return at

    def predict(self, x: np.ndarray) -> np.ndarray:
        return np.array(self.value).take(self.leaf_of(x))


@dataclass
class Boosted:
    """A boosted model: a mean and trees, of which the first `rounds` count; `errors` are the RMSE of the
    held-out rows before the first and after each round, where there were any."""

    bins: Bins
    base: float
    trees: list[Tree]
    rounds: int
    errors: list[float]

    @property
    def rmse(self) -> float:
        return self.errors[self.rounds]

    def transform(self, df: DataFrame) -> DataFrame:
        """`df` with its `prediction`."""
        return self._scored(df, [self.rounds]).withColumn("prediction", F.col("prediction")[0])

    def predictions_by_round(self, df: DataFrame) -> DataFrame:
        """`df` with `prediction`, an array: before the first round and after each one that was grown."""
        return self._scored(df, range(len(self.trees) + 1))

    def _scored(self, df: DataFrame, after: Sequence[int]) -> DataFrame:
        base, trees, marks = self.base, self.trees, set(after)

        @F.pandas_udf("array<double>")
        def scored(bins: pd.Series) -> pd.Series:
            x = np.stack(bins.to_numpy()) if len(bins) else np.zeros((0, 1), dtype=np.int8)
            total, held = np.full(len(x), base), []
            for number in range(max(marks) + 1):
                if number:
                    total = total + trees[number - 1].predict(x)
                if number in marks:
                    held.append(total)
            return pd.Series(list(np.stack(held, axis=1)))

        named = with_bins(df, self.bins, "__x").withColumn("prediction", scored("__x"))
        return named.drop("__x")


def _rows_of(lists: pa.ListArray, width: int) -> np.ndarray:
    return np.asarray(lists.flatten()).reshape(-1, width)


@dataclass
class _Growing:
    """A parameter set on its way: its trees, the current one, the current tree's open nodes."""

    number: int
    settings: Settings
    trees: list[Tree] = field(default_factory=list)
    errors: list[float] = field(default_factory=list)
    tree: Tree | None = None
    open: list[int] = field(default_factory=list)
    features: list[int] = field(default_factory=list)
    leaves: int = 1
    done: bool = False

    def begin(self, width: int, seed: int) -> None:
        rng = random.Random(f"{seed}:{self.number}:{len(self.trees)}")
        self.features = sorted(rng.sample(range(width), max(1, round(width * self.settings.colsample_bytree))))
        self.tree, self.leaves = Tree(), 1
        self.open = [self.tree.add(0.0)]

    def grow(self, cuts: Sequence[tuple[int, int, int, float, float, float]]) -> None:
        """Split open nodes by (place, feature, bin, gain, left value, right value), the best first, while leaves are left."""
        children = []
        for place, feature, cut, _, left, right in sorted(cuts, key=lambda c: (-c[3], c[0])):
            if self.leaves == self.settings.num_leaves:
                break
            node = self.open[place]
            self.tree.feature[node], self.tree.cut[node] = feature, cut
            self.tree.left[node] = self.tree.add(left * self.settings.learning_rate)
            children += [self.tree.left[node], self.tree.add(right * self.settings.learning_rate)]
            self.leaves += 1
        self.open = children if self.leaves < self.settings.num_leaves else []


def _kept_rows(x: np.ndarray, fraction: float, seed: str) -> np.ndarray:
    """Whether a row's bins are in the sample that the seed stands for."""
    return _kept(_places(x), fraction, seed)


def _places(x: np.ndarray) -> np.ndarray:
    """The bins by feature, counted from 1."""
    return np.ascontiguousarray(x.T).astype(np.uint64) + np.uint64(1)


def _kept(places: np.ndarray, fraction: float, seed: str) -> np.ndarray:
    if fraction >= 1:
        return np.ones(places.shape[1], dtype=bool)
    rng = np.random.default_rng(np.frombuffer(seed.encode(), dtype=np.uint8))
    odd = rng.integers(0, 1 << 62, len(places), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    key = np.zeros(places.shape[1], dtype=np.uint64)
    for own, factor in zip(places, odd):
        key += own * factor
    key = (key ^ (key >> np.uint64(31))) * odd[0]
    key = (key ^ (key >> np.uint64(29))) * odd[-1]
    return (key >> np.uint64(11)) < np.uint64(int(fraction * (1 << 53)))


_PARTIAL = "number int, part int, width int, sums binary"
_CUT = "number int, place int, feature int, cut int, gain double, left double, right double"
_ERROR_PART = -1


def _level(rows: DataFrame, growing: Sequence[_Growing], width: int, pending: int, seed: int, errors: bool, tasks: int) -> list:
    """One pass: the best cut of every open node and, if asked for, (number, -1, ...) with the held-out squares and count."""
    first = {g.number: len(g.trees) - pending for g in growing}
    bins = BINS

    def margins_of(batch: pa.RecordBatch, x: np.ndarray, g: _Growing) -> np.ndarray:
        margin = np.asarray(batch.column("margins").flatten()).reshape(len(x), -1)[:, g.number]
        for tree in g.trees[first[g.number] :]:
            margin = margin + tree.predict(x)
        return margin

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {g.number: np.zeros((len(g.open), len(g.features), bins, 2)) for g in growing}
        squares = {g.number: np.zeros(2) for g in growing}
        for batch in batches:
            x = _rows_of(batch.column("x"), width)
            n, total, square = (np.asarray(batch.column(c)) for c in ("n", "total", "squares"))
            held = np.asarray(batch.column("held_out").to_numpy(zero_copy_only=False), dtype=bool)
            for g in growing:
                margin = margins_of(batch, x, g)
                if errors:
                    m, h = margin[held], held
                    squares[g.number] += (square[h] - 2 * m * total[h] + n[h] * m * m).sum(), n[h].sum()
                if not g.open:
                    continue
                place = np.full(len(g.tree.value), -1)
                place[g.open] = np.arange(len(g.open))
                at = place[g.tree.leaf_of(x)]
                used = np.flatnonzero((at >= 0) & ~held & _kept_rows(x, g.settings.subsample, f"{seed}:{g.number}:{len(g.trees)}"))
                residual = (total - n * margin)[used]
                for k, feature in enumerate(g.features):
                    key = at[used] * bins + x[used, feature]
                    for what, weights in enumerate((residual, n[used])):
                        sums[g.number][:, k, :, what] += np.bincount(key, weights, len(g.open) * bins).reshape(-1, bins)
        out = [(g.number, _ERROR_PART, 0, squares[g.number].tobytes()) for g in growing if errors]
        for g in growing:
            for low in range(0, len(g.open), NODES):
                out.append((g.number, low // NODES, len(g.features), sums[g.number][low : low + NODES].tobytes()))
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["number", "part", "width", "sums"])

    settings = {g.number: (g.settings, g.features) for g in growing}

    def choose(table: pa.Table) -> pa.Table:
        number, part, features = (table.column(c)[0].as_py() for c in ("number", "part", "width"))
        summed = sum(np.frombuffer(b, dtype=np.float64) for b in table.column("sums").to_pylist())
        if part == _ERROR_PART:
            cuts = [(number, -1, 0, 0, 0.0, float(summed[0]), float(summed[1]))]
        else:
            cuts = _best_cuts(number, part * NODES, summed.reshape(-1, features, bins, 2), *settings[number])
        kinds = (pa.int32(),) * 4 + (pa.float64(),) * 3
        columns = zip(*cuts) if cuts else [()] * 7
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["number", "place", "feature", "cut", "gain", "left", "right"])

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in partial(batches):
            for k in range(len(batch)):
                yield from choose(pa.Table.from_batches([batch.slice(k, 1)])).to_batches()

    if tasks == 1:  # the only task's sums are the whole sums
        return rows.coalesce(1).mapInArrow(alone, _CUT).collect()
    return rows.mapInArrow(partial, _PARTIAL).groupBy("number", "part").applyInArrow(choose, _CUT).collect()


def _best_cuts(number: int, first: int, sums: np.ndarray, settings: Settings, features: Sequence[int]) -> list[tuple]:
    """Per node of `sums` (node, feature, bin, [residuals, rows]) its best cut, where any lowers the penalised error."""
    alpha, penalty = settings.reg_alpha, settings.reg_lambda

    def weight(residuals: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.sign(residuals) * np.maximum(np.abs(residuals) - alpha, 0) / np.maximum(rows + penalty, 1e-300)

    def score(residuals: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.maximum(np.abs(residuals) - alpha, 0) ** 2 / np.maximum(rows + penalty, 1e-300)

    left = sums.cumsum(axis=2)
    whole = left[:, :, -1:]
    right = whole - left
    gain = score(left[..., 0], left[..., 1]) + score(right[..., 0], right[..., 1]) - score(whole[..., 0], whole[..., 1])
    enough = np.minimum(left[..., 1], right[..., 1]) >= max(settings.min_child_samples, 1)
    flat = np.where(enough, gain, 0.0).reshape(len(sums), -1)
    best = flat.argmax(axis=1)
    gains = flat[np.arange(len(sums)), best]
    node = np.flatnonzero(gains > LEAST_GAIN)
    k, cut = np.divmod(best[node], sums.shape[2])
    sides = (weight(side[node, k, cut, 0], side[node, k, cut, 1]).tolist() for side in (left, right))
    chosen = (features[j] for j in k.tolist())
    return [(number, *c) for c in zip((first + node).tolist(), chosen, cut.tolist(), gains[node].tolist(), *sides)]


_WHOLE = "number int, errors array<double>, sizes array<int>, nodes binary"
_NODE = np.dtype([("feature", np.int16), ("cut", np.int16), ("left", np.int32), ("value", np.float64)])


def _grow_tree(g: _Growing, columns: np.ndarray, n: np.ndarray, residual: np.ndarray) -> None:
    """The current tree of a set over all rows it is fitted on: bins by feature, counts, sums of residuals."""
    least = 2 * max(g.settings.min_child_samples, 1)
    at, wide = np.zeros(len(n), dtype=np.int64), len(columns)
    column_of = np.zeros(g.features[-1] + 1, dtype=np.int64)
    column_of[g.features] = np.arange(wide)
    for _ in range(g.settings.max_depth):
        nodes = np.array(g.open, dtype=np.int64)
        place = np.full(len(g.tree.value), len(nodes))
        place[nodes] = np.arange(len(nodes))
        large = np.flatnonzero(np.bincount(place.take(at), n, len(nodes) + 1)[:-1] >= least)  # others can't be cut
        if not len(large):
            return
        place[:] = len(large)  # rows of no node that can be cut have their sums behind the others'
        place[nodes[large]] = np.arange(len(large))
        own = place.take(at)
        stay = np.flatnonzero(own < len(large))
        if len(stay) < FEW * len(own):
            own, at, n, residual, columns = own.take(stay), at.take(stay), n.take(stay), residual.take(stay), columns.take(stay, axis=1)
        own *= BINS
        sums = np.empty((len(large), wide, BINS, 2))
        for k in range(wide):
            key = own + columns[k]
            for what, weights in enumerate((residual, n)):
                sums[:, k, :, what] = np.bincount(key, weights, (len(large) + 1) * BINS).reshape(-1, BINS)[:-1]
        g.grow([(int(large[c[1]]), *c[2:]) for c in _best_cuts(g.number, 0, sums, g.settings, g.features)])
        if not g.open:
            return
        feature, cut, left = np.array(g.tree.feature), np.array(g.tree.cut), np.array(g.tree.left)
        leaf = np.flatnonzero(feature < 0)
        column, left[leaf] = column_of[np.maximum(feature, 0)], leaf
        cut[leaf] = BINS
        column[leaf] = 0
        bins = columns.reshape(-1).take(column.take(at) * len(at) + np.arange(len(at)))
        at = left.take(at) + (bins > cut.astype(np.int8).take(at))


def _grow_whole(g: _Growing, x: np.ndarray, n: np.ndarray, total: np.ndarray, squares: np.ndarray, held: np.ndarray, base: float, seed: int, patience: int) -> None:
    """All rounds of a set over the whole table; errors where rows are held out."""
    fit, out = np.flatnonzero(~held), np.flatnonzero(held)
    columns, places = np.ascontiguousarray(x[fit].T), _places(x[fit])
    fit_n, fit_total, out_n, out_total, out_squares = n[fit], total[fit], n[out], total[out], squares[out]
    margin, rows = np.full(len(x), base), out_n.sum()
    while True:
        if len(out):
            m = margin.take(out)
            square = (out_squares - 2 * m * out_total + out_n * m * m).sum()
            g.errors.append(math.sqrt(max(float(square), 0.0) / float(rows)))
        if len(g.trees) == g.settings.n_estimators or _ended(g.errors, patience):
            return
        g.begin(x.shape[1], seed)
        used = np.flatnonzero(_kept(places, g.settings.subsample, f"{seed}:{g.number}:{len(g.trees)}"))
        residual = fit_total - fit_n * margin.take(fit)
        _grow_tree(g, columns[g.features].take(used, axis=1), fit_n.take(used), residual.take(used))
        margin += g.tree.predict(x)
        g.trees.append(g.tree)


def _by_set(rows: DataFrame, growing: Sequence[_Growing], width: int, base: float, seed: int, patience: int, keep_trees: bool) -> None:
    """Grow each set over `rows`, by a task of its own; those likely to take longest begin first."""
    settings = {g.number: g.settings for g in growing}

    def grown(table: pa.Table) -> pa.Table:
        number = table.column("number")[0].as_py()
        x = _rows_of(table.column("x").combine_chunks(), width)
        n, total, squares = (table.column(c).to_numpy() for c in ("n", "total", "squares"))
        out = table.column("held_out").to_numpy().astype(bool)
        g = _Growing(number, settings[number])
        _grow_whole(g, x, n, total, squares, out, base, seed, patience)
        nodes = [np.rec.fromarrays([t.feature, t.cut, t.left, t.value], dtype=_NODE).tobytes() for t in g.trees] if keep_trees else []
        sizes = [len(t.value) for t in g.trees]
        kinds = (pa.int32(), pa.list_(pa.float64()), pa.list_(pa.int32()), pa.binary())
        row = (number, g.errors, sizes, b"".join(nodes))
        return pa.Table.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], ["number", "errors", "sizes", "nodes"])

    order = sorted(growing, key=lambda g: -min(g.settings.n_estimators, 10 / g.settings.learning_rate) * g.settings.max_depth)
    turns = F.posexplode(F.array(*(F.lit(g.number) for g in order))).alias("turn", "number")
    dealt = rows.select("held_out", "x", "n", "total", "squares", turns).repartitionById(len(order), "turn")
    for row in dealt.groupBy("turn").applyInArrow(grown, _WHOLE).collect():
        g = growing[row["number"]]
        g.errors, nodes = row["errors"], np.frombuffer(row["nodes"], dtype=_NODE)
        if keep_trees:
            ends = np.cumsum(row["sizes"], dtype=np.int64)
            g.trees = [Tree(*(nodes[c][e - s : e].tolist() for c in _NODE.names)) for s, e in zip(row["sizes"], ends)]


def _with_margins(rows: DataFrame, growing: Sequence[_Growing], width: int, pending: int) -> DataFrame:
    """The table with the last `pending` trees of each set added to the margins, written."""
    schema = rows.schema

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _rows_of(batch.column("x"), width)
            margins = np.array(batch.column("margins").flatten()).reshape(len(x), -1)
            for g in growing:
                for tree in g.trees[len(g.trees) - pending :]:
                    margins[:, g.number] += tree.predict(x)
            at = batch.schema.get_field_index("margins")
            offsets = pa.array(np.arange(0, margins.size + 1, margins.shape[1], dtype=np.int32))
            yield batch.set_column(at, "margins", pa.ListArray.from_arrays(offsets, pa.array(margins.ravel())))

    return cut_lineage(rows.mapInArrow(add, schema))


def _training_table(
    df: DataFrame, label: str, columns: Sequence[str], validated: bool = False
) -> tuple[DataFrame, Bins, float, int]:
    """(written table, bins, mean label, tasks that passes read it with) of rows with `held_out`."""
    rows = df.withColumn("__label", quoted(label).cast("double")).where("__label IS NOT NULL")
    bins = fit_bins(rows.where("NOT held_out"), columns)
    square = F.col("__label") * F.col("__label")
    binned = with_bins(rows, bins).groupBy("held_out", "x").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum("__label").alias("total"), F.sum(square).alias("squares")
    )
    table = cut_lineage(binned)
    sums = table.groupBy("held_out").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.count(F.lit(1)).alias("rows"))
    sizes = {r["held_out"]: r for r in sums.collect()}
    if False not in sizes or (validated and True not in sizes):
        raise ValueError("boosting needs rows to fit on and rows to validate on")
    base = sizes[False]["total"] / sizes[False]["n"]
    tasks = 1 + sum(s["rows"] for s in sizes.values()) // TASK_ROWS
    return table, bins, base, tasks


def _with_first_margins(table: DataFrame, base: float, sets: int, tasks: int) -> DataFrame:
    """The table for passes, written with a margin per set."""
    margins = F.array_repeat(F.lit(base), sets)
    return cut_lineage(table.withColumn("margins", margins).coalesce(tasks)).coalesce(tasks)


def boost(
    df: DataFrame,
    params: Sequence[Mapping[str, object]],
    validate_on: str | None = None,
    label: str = "demand",
    patience: int = PATIENCE,
    seed: int = SEED,
    columns: Sequence[str] = FEATURE_COLUMNS,
    keep_trees: bool = True,
) -> list[Boosted]:
    """A boosted model per parameter set, all grown in the same passes over `df`, or each by a task where its binned table is small.

    With `validate_on` (a boolean column) boosting of a set ends `patience` rounds after the least RMSE of
    the rows it marks, or after `n_estimators` rounds, and the model has the rounds up to that least. Without,
    all rows are fitted on and the model has `n_estimators` rounds. Trees grow level by level, best cuts
    first, up to `num_leaves`; rows of a `subsample` are drawn by a hash of their bins. A tree that finds no
    cut is a root of value 0. Rows without a label are left out; nothing to fit on or validate on is an error.
    Without `keep_trees` the models have their rounds and errors, but can't predict.
    """
    held_out = F.coalesce(F.col(validate_on), F.lit(False)) if validate_on else F.lit(False)
    table, bins, base, tasks = _training_table(df.withColumn("held_out", held_out), label, columns, validate_on is not None)
    growing = [_Growing(k, Settings.of(p)) for k, p in enumerate(params)]
    if tasks == 1:
        _by_set(table.coalesce(1), growing, len(columns), base, seed, patience, keep_trees)
    else:
        _in_passes(_with_first_margins(table, base, len(params), tasks).persist(), growing, len(columns), tasks, validate_on is not None, seed, patience)
    return [
        Boosted(bins, base, g.trees if keep_trees else [], best_round(g.errors) if g.errors else g.settings.n_estimators, g.errors) for g in growing
    ]


def _in_passes(table: DataFrame, growing: Sequence[_Growing], width: int, tasks: int, validated: bool, seed: int, patience: int) -> None:
    """Grow all sets level by level, each level of all of them by one pass over `table`."""
    pending = 0
    while active := [g for g in growing if not g.done]:
        for g in active:
            g.begin(width, seed)
        for level in range(max(g.settings.max_depth for g in active)):
            now = [g for g in active if g.open and level < g.settings.max_depth]
            if not now:
                break
            found: dict[int, list] = {g.number: [] for g in now}
            for number, place, *cut in _level(table, now, width, pending, seed, validated and level == 0, tasks):
                if place < 0:
                    growing[number].errors.append(math.sqrt(max(cut[3], 0.0) / cut[4]))
                else:
                    found[number].append((place, *cut))
            for g in now:
                if level == 0 and (len(g.trees) == g.settings.n_estimators or _ended(g.errors, patience)):
                    g.done, g.open = True, []
                else:
                    g.grow(found[g.number])
        grown = [g for g in active if not g.done]
        for g in grown:
            g.trees.append(g.tree)
        pending += 1
        if pending == WRITE_EVERY and grown:
            written = _with_margins(table, grown, width, pending).coalesce(tasks).persist()
            table.unpersist()
            table, pending = written, 0
    table.unpersist()


def root_cuts(df: DataFrame, label: str = "demand", params: Mapping[str, object] | None = None, columns: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """(name, edge, gain, left, right) per feature that can be cut: its best first cut, rows below `edge` going left.

    The same pass that grows trees, with a set per feature.
    """
    table, bins, base, tasks = _training_table(df.withColumn("held_out", F.lit(False)), label, columns)
    table = _with_first_margins(table, base, len(columns), tasks)
    growing = [_Growing(k, Settings.of(params or {})) for k in range(len(columns))]
    for g in growing:
        g.begin(len(columns), SEED)
        g.features = [g.number]
    found = _level(table, growing, len(columns), 0, SEED, False, 1)
    rows = [(columns[k], bins.edges[k][cut], gain, base + left, base + right) for k, _, _, cut, gain, left, right in found]
    return df.sparkSession.createDataFrame(rows, "name string, edge double, gain double, left_mean double, right_mean double")


def best_round(errors: Sequence[float]) -> int:
    """The first round with the least error; errors[0] is that before any round, which counts only alone."""
    return min(range(1, len(errors)), key=lambda k: (errors[k], k), default=0)


def _ended(errors: Sequence[float], patience: int) -> bool:
    return len(errors) > 1 and len(errors) - 1 - best_round(errors) >= patience


def save_boosted(spark: SparkSession, model: Boosted, path: str) -> str:
    """Write the model as two tables, `trees` (a row per node of the rounds that count) and `bins` (a row per feature)."""
    nodes = [
        (t, k, tree.feature[k], tree.cut[k], tree.left[k], tree.value[k]) for t, tree in enumerate(model.trees[: model.rounds]) for k in range(len(tree.value))
    ]
    features = [(k, c, list(model.bins.edges[k]), model.base) for k, c in enumerate(model.bins.columns)]
    spark.createDataFrame(nodes, "tree int, node int, feature int, cut int, left int, value double").write.mode("overwrite").parquet(f"{path}/trees")
    spark.createDataFrame(features, "feature int, name string, edges array<double>, base double").write.mode("overwrite").parquet(f"{path}/bins")
    return path


def load_boosted(spark: SparkSession, path: str) -> Boosted:
    """A saved model; the errors of its boosting are not kept."""
    features = spark.read.parquet(f"{path}/bins").orderBy("feature").collect()
    trees: dict[int, Tree] = {}
    for r in spark.read.parquet(f"{path}/trees").orderBy("tree", "node").collect():
        tree = trees.setdefault(r["tree"], Tree())
        for name in ("feature", "cut", "left", "value"):
            getattr(tree, name).append(r[name])
    bins = Bins(tuple(r["name"] for r in features), tuple(tuple(r["edges"]) for r in features))
    return Boosted(bins, features[0]["base"], [trees[k] for k in sorted(trees)], len(trees), [])
