"""Projections, unions, range filters, sorts and distinct rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demand_engine.functions.times import ntz

DATE_PARTITION = "started_date"


def quoted(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def _check_unique(names: Sequence[str]) -> None:
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"two columns would share a name: {', '.join(twice)}")


def rename_known(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that occur in `names`, matching case exactly; leave the others."""
    _check_unique([names.get(c, c) for c in df.columns])
    return df.select([quoted(c).alias(names.get(c, c)) for c in df.columns])


def rename_required(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns that all have to be there."""
    absent = [c for c in names if c not in df.columns]
    if absent:
        raise ValueError(f"no such column: {', '.join(absent)}")
    return rename_known(df, names)


def add_absent(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Add each column of `types` the table lacks, as a typed null."""
    return df.withColumns(
        {c: F.lit(None).cast(t) for c, t in types.items() if c not in df.columns}
    )


def canonical(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Known columns first, in declared order and type; other columns follow as they are.

    A text that cannot be read as its declared type becomes null (`quality.unreadable` counts them).
    """
    df = add_absent(df, types)
    extra = [quoted(c) for c in df.columns if c not in types]
    return df.select([quoted(c).try_cast(t).alias(c) for c, t in types.items()] + extra)


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, whole) and isinstance(b, whole):
        return a if whole.index(type(a)) > whole.index(type(b)) else b
    numeric = (*whole, T.FloatType, T.DoubleType)
    if isinstance(a, numeric) and isinstance(b, numeric):
        return T.DoubleType()
    if isinstance(a, (T.DateType, T.TimestampNTZType)) and isinstance(
        b, (T.DateType, T.TimestampNTZType)
    ):
        return T.TimestampNTZType()
    return T.StringType()


def union_relaxed(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, columns by name, absent ones null, differing types widened.

    Numbers widen to the larger number type; a number and a text widen to text. (Left to itself
    Spark would read the text as a number and fail on one that is not.)
    """
    wide: dict[str, T.DataType] = {}
    for frame in frames:
        for field in frame.schema.fields:
            seen = wide.get(field.name, field.dataType)
            wide[field.name] = _wider(seen, field.dataType)
    aligned = [
        f.select(
            [
                (quoted(c).cast(t) if c in f.columns else F.lit(None).cast(t)).alias(c)
                for c, t in wide.items()
            ]
        )
        for f in frames
    ]
    return reduce(DataFrame.unionByName, aligned)


def between(df: DataFrame, column: str, start: datetime, end: datetime) -> DataFrame:
    """Rows in the closed range. The raw column is compared, so the filter reaches the scan; a date
    partition of the trips table is narrowed as well."""
    rows = df.where(F.col(column).between(ntz(start), ntz(end)))
    if column == "started_at" and DATE_PARTITION in df.columns:
        rows = rows.where(
            F.col(DATE_PARTITION).between(F.lit(start.date()), F.lit(end.date()))
        )
    return rows


def from_time(df: DataFrame, column: str, cutoff: datetime | Column) -> DataFrame:
    return df.where(F.col(column) >= ntz(cutoff))


def before_time(df: DataFrame, column: str, cutoff: datetime | Column) -> DataFrame:
    return df.where(F.col(column) < ntz(cutoff))


def without_nulls(
    df: DataFrame, columns: Sequence[str] | None = None, pushed: bool = True
) -> DataFrame:
    """Rows with a value in every column. NaN counts as a value, unlike in `DataFrame.dropna`.

    `pushed=False` states the condition as one number, which Spark does not take apart and move
    towards the scan. That is for a table whose unfiltered rows are read in the same plan, see
    `whole_rows`.
    """
    values = [quoted(c) for c in columns or df.columns]
    if pushed:
        return df.where(reduce(and_, (v.isNotNull() for v in values)))
    return df.where(reduce(add, (v.isNull().cast("int") for v in values)) == 0)


def whole_rows(df: DataFrame) -> DataFrame:
    """All rows of `df`, with every column in use.

    For a second look at a table inside one plan, such as its column means. The filter is true for
    each row; it only keeps the optimizer from dropping columns in one of the two branches. With
    the same columns on both sides Spark runs their common shuffle once, otherwise the input would
    be scanned and shuffled twice.
    """
    return df.where(F.xxhash64(*(quoted(c) for c in df.columns)) >= F.lit(-(2**63)))


def span(df: DataFrame, low: str = "started_at", high: str = "ended_at") -> DataFrame:
    """One row: earliest `low` and latest `high`."""
    return df.agg(F.min(low).alias("min_time"), F.max(high).alias("max_time"))


def latest_per_key(
    df: DataFrame, keys: Sequence[str], rank: Sequence[str] | str
) -> DataFrame:
    """One row per key, the one ranked last. Null keys form one group; nulls in the row are kept.

    Every column uses the same ranking, so the values of one output row stem from one input row.
    """
    ranks = [rank] if isinstance(rank, str) else list(rank)
    order = F.col(ranks[0]) if len(ranks) == 1 else F.struct(*ranks)
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(*(F.max_by(c, order).alias(c) for c in rest)).select(df.columns)
