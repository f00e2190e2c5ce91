"""Left lookup joins from a large table into a small or a large one."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demand_engine.operators.tables import quoted

# A table goes to every executor only when its exact size is within both bounds.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 256 * 1024 * 1024


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int

    def fits(self, rows: int = BROADCAST_ROWS, limit: int = BROADCAST_BYTES) -> bool:
        return self.rows <= rows and self.bytes <= limit


def measure(df: DataFrame) -> Size:
    """Exact row count and value bytes, as one aggregate row."""

    def width(field: T.StructField) -> Column:
        value = quoted(field.name)
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(value), F.lit(0)) + F.lit(16)
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.octet_length(F.to_json(F.struct(value))) + F.lit(16)
        return F.lit(16)

    total = reduce(lambda a, b: a + b, (width(f).cast("bigint") for f in df.schema.fields))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(total).alias("b")).first()
    return Size(row["n"], row["b"] or 0)


def _suffixed(left: DataFrame, right: DataFrame, on: Sequence[str], suffix: str) -> DataFrame:
    """The right table with every non-key name that the left one also has marked by `suffix`."""
    names = {c: c + suffix for c in right.columns if c not in on and c in left.columns}
    clash = [n for n in names.values() if n in left.columns or n in right.columns]
    if clash:
        raise ValueError(f"two columns would share a name: {', '.join(clash)}")
    return right.select([quoted(c).alias(names.get(c, c)) for c in right.columns])


def left_lookup(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    size: Size | None = None,
    suffix: str = "_right",
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left join on equal keys; every left row stays, a row with several partners repeats.

    The right side is measured first (pass `size` if that is known). Within the bounds it is
    broadcast and the left side is not shuffled at all. Beyond them it is a sort-merge join, in which
    adaptive execution splits what the left side has of a hot key, or of no key, over several tasks
    (`spark.sql.adaptive.skewJoin`, on in `session.engine_session`).
    """
    right = _suffixed(left, right, on, suffix)
    if (size or measure(right)).fits(max_rows, max_bytes):
        return left.join(F.broadcast(right), list(on), "left")
    return left.join(right.hint("merge"), list(on), "left")
