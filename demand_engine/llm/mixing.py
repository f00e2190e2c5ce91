"""Mixing sources to target weights, in DataFrame functions only.

Words are summed per source, each source gets a target and with it a repetition rate, and each
document is emitted floor(rate) times, plus once more if a number drawn from its own hash is below
the rate's fraction. The draw depends on the document alone: reruns and lost tasks give the same mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demand_engine.llm.ranges import running
from demand_engine.session import cut_lineage

#: Weights of the sources in order, repeating; words wanted per word there is; most repetitions.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2.0
_WORD = r"[^\x20\x09-\x0D]+"
_DRAW_DIGITS = 13


def n_words(text: Column) -> Column:
    """Number of words that white space separates; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("bigint")


def draw(doc_id: Column, text: Column, seed: str) -> Column:
    """A number in [0, 1) that only the id, the text and the seed decide."""
    own = F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    digits = F.substring(F.md5(own.cast("binary")), 1, _DRAW_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(float(16**_DRAW_DIGITS))


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """(source, source_size, target) per source of `sizes` (source, size).

    The sources, by code point and null last, take the weights in turn. Together they get `share` times
    all words, in proportion to the weights; none gets more than `most` times its own words, and what
    one can't take the others share by weight. That is the level at which the targets, each the level
    times the weight or the source's limit, add up: taking sources by limit per weight, one is at its
    limit if the level left for it and those behind it is above. There may be any number of sources.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = running(per, [], [F.col("source").asc_nulls_last()], {"__rank": F.lit(1)})
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("__rank") % len(weights) + 1).cast("int"))
    limit = F.col("source_size") * F.lit(most)
    weighed = ranked.select("source", "source_size", weight.cast("double").alias("__weight"), limit.alias("__limit"))
    by_limit = [(F.col("__limit") / F.col("__weight")).asc(), F.col("source").asc_nulls_last()]
    filled = cut_lineage(
        running(weighed, [], by_limit, {"__limits": F.col("__limit"), "__weights": F.col("__weight")})
    )
    whole = filled.agg(F.struct(F.sum("source_size").alias("words"), F.sum("__weight").alias("weights"))).scalar()
    wanted, weights_left = whole["words"] * F.lit(share), whole["weights"] - F.col("__weights")
    is_full = F.col("__limit") * weights_left < F.col("__weight") * (wanted - F.col("__limits"))
    marked = cut_lineage(filled.withColumns({"__full": is_full, "__wanted": wanted, "__sum": whole["weights"]}))
    full = marked.where("__full").agg(
        F.struct(
            F.coalesce(F.sum("__limit"), F.lit(0.0)).alias("limits"),
            F.coalesce(F.sum("__weight"), F.lit(0.0)).alias("weights"),
        )
    ).scalar()
    level = F.col("__weight") * (F.col("__wanted") - full["limits"]) / (F.col("__sum") - full["weights"])
    target = F.when(F.col("__full"), F.col("__limit")).otherwise(F.least(level, F.col("__limit")))
    return cut_lineage(marked.select("source", "source_size", target.alias("target")))


def _copies(drawn: Column) -> Column:
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(0.0))
    return F.floor(rate) + (drawn < rate - F.floor(rate)).cast("bigint")


def _with_targets(rows: DataFrame, targets: DataFrame, source: str) -> DataFrame:
    wanted = targets.withColumnRenamed("source", "__of")
    return rows.join(wanted, F.col(source).eqNullSafe(F.col("__of"))).drop("__of")


def mix_plan(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = "mix"
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) per row of `docs`, left-out ones too.

    A null text has no words; a source without words gets a target of 0 and no copies. Null is a source
    of its own, the last. Rows that repeat id and text share one draw; a null id draws by the text.
    Other columns are ignored. An empty table gives an empty plan.

    Texts are read once; from then on one narrow row per document is moved. Sources are joined by
    whatever the size of their table allows, and a source with a third of all rows is summed before
    the shuffle and split by adaptive execution in a shuffled join.
    """
    sized = cut_lineage(
        docs.select(
            "doc_id", "source", n_words(F.col("text")).alias("size"), draw(F.col("doc_id"), F.col("text"), seed).alias("__draw")
        )
    )
    targets = source_targets(sized, weights, share, most)
    planned = _with_targets(sized, targets, "source")
    return planned.select("doc_id", "source", "size", "source_size", "target", _copies(F.col("__draw")).alias("copies"))


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = "mix"
) -> DataFrame:
    """The mix itself: each row of `docs`, all its columns, as often as `mix_plan` says, with `copy` from 1 up.

    A column `copy` that `docs` has is replaced.
    """
    sizes = cut_lineage(docs.select("source", n_words(F.col("text")).alias("size")))
    held = [c for c in docs.columns if c.lower() != "copy"]
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in held)).alias("__doc"),
        F.col("source").alias("__source"),
        draw(F.col("doc_id"), F.col("text"), seed).alias("__draw"),
    )
    planned = _with_targets(rows, source_targets(sizes, weights, share, most), "__source")
    times = planned.withColumn("__copies", _copies(F.col("__draw"))).where("__copies > 0")
    return times.select("__doc.*", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))).alias("copy"))


def mix_report(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken): the words that the mix takes of each document."""
    return mix_plan(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
