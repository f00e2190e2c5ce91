"""Running totals of a table whose groups may be too large for one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demand_engine.session import cut_lineage


def running(df: DataFrame, within: Sequence[str], order: Sequence[Column], sums: Mapping[str, Column]) -> DataFrame:
    """`df` with a column per entry of `sums`: its total over the earlier rows of the same group.

    `within` names the columns of a group (none: the whole table is one), `order` sorts its rows; rows
    that tie may take either place. The table is cut into ranges of (group, order), totals are taken
    inside each range, and what earlier ranges hold of the same group is added. A group may span any
    number of ranges. At most one row per range is carried over, so these rows can be broadcast.
    Spark samples `df` for the ranges, so it should be cheap to read. An empty table gives an empty one.
    """
    ranged = df.withColumns({f"__{name}": value for name, value in sums.items()})
    ranged = ranged.repartitionByRange(*(F.col(c).asc() for c in within), *order)
    placed = cut_lineage(ranged.withColumn("__range", F.spark_partition_id()))

    earlier_rows = Window.partitionBy("__range", *within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier_ranges = Window.partitionBy(*within).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    whole = placed.groupBy("__range", *within).agg(*(F.sum(f"__{name}").alias(f"__{name}") for name in sums))
    carried = whole.select(
        F.col("__range").alias("__to"),
        *(F.col(c).alias(f"__of_{c}") for c in within),
        F.lag("__range").over(Window.partitionBy(*within).orderBy("__range")).alias("__from"),
        *(F.sum(f"__{name}").over(earlier_ranges).alias(f"__carried_{name}") for name in sums),
    ).where("__from IS NOT NULL")

    same = F.col("__range") == F.col("__to")
    for c in within:
        same &= F.col(c).eqNullSafe(F.col(f"__of_{c}"))
    inside = placed.withColumns({f"__inside_{name}": F.sum(f"__{name}").over(earlier_rows) for name in sums})
    joined = inside.join(F.broadcast(carried), same, "left")
    zero = F.lit(0)
    return joined.select(
        *df.columns,
        *((F.coalesce(f"__inside_{name}", zero) + F.coalesce(f"__carried_{name}", zero)).alias(name) for name in sums),
    )
