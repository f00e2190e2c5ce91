"""Fitting on a bounded sample inside one task; the driver sees the fitted bytes only."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def remainder(id_col: Column, divisor: int) -> Column:
    """crc32 of an id's text, modulo `divisor`; null for a null id."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(divisor))


#: Rows that a fit takes at most, about, over all labels.
SAMPLE_ROWS = 24_000


def bounded_sample(rows: DataFrame, by: str, label: str, bound: int, total: int = SAMPLE_ROWS) -> DataFrame:
    """About `bound` rows per label at most, and `total` in all, chosen by a hash of `by`; all rows where there are fewer.

    Many labels share the total evenly. Were there more labels than that, the `total` most frequent ones
    would be taken, with about a row each.
    """
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("__n")).orderBy(F.col("__n").desc(), label).limit(total)
    labels = F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))
    each = F.least(F.lit(float(bound)), F.lit(float(total)) / labels)
    shares = counts.select(label, F.least(F.lit(1.0), each / F.col("__n")).alias("__share"))
    place = F.pmod(F.xxhash64(F.col(by), F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.join(F.broadcast(shares), label).where(place < F.col("__share")).drop("__share")


def fit_in_one_task(sample: DataFrame, fit: Callable[[pa.Table], bytes]) -> bytes | None:
    """`fit` over the whole (bounded) sample, in a task; None for an empty sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([fit(pa.Table.from_batches(held))], pa.binary())], ["model"])

    row = sample.repartition(1).mapInArrow(run, "model binary").first()
    return bytes(row["model"]) if row else None
