"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demand_engine.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every id in `edges` (a, b: bigint); ids have one root if and only if links connect them.

    Each id takes its least neighbour's id, the graph is contracted to those, and so on until no
    edge is left between different ids. Ids should be hashes: the number of ids then shrinks by a
    constant factor per level. A hub's edges meet a table of one row per id, which adaptive
    execution splits. Edges from an id to itself are allowed. An empty table gives an empty one.
    """
    edges = cut_lineage(edges.select("a", "b"))
    levels = []
    while True:
        both = edges.union(edges.select("b", "a")).toDF("id", "other")
        least = cut_lineage(both.groupBy("id").agg(F.least("id", F.min("other")).alias("root")))
        levels.append(least)
        a, b = least.toDF("a", "ra"), least.toDF("b", "rb")
        edges = cut_lineage(
            edges.join(a, "a").join(b, "b").where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct()
        )
        if edges.isEmpty():
            break
    found = levels[0]
    for level in levels[1:]:
        found = found.join(level.toDF("root", "next"), "root", "left").select("id", F.coalesce("next", "root").alias("root"))
    return cut_lineage(found)
