"""Exact duplicates by content-defined chunk recipes, in DataFrame functions only.

A text is cut where its content says so: after the first white space behind one of some pairs of
characters, `least` characters or more from the last cut, and at `most` characters where there is
none. About one place in a hundred qualifies, so that texts which differ by an insertion soon have
the same cuts again. Each chunk gets a compact identifier; identifiers are
verified to stand for one content each by the SHA-256 of all chunks that carry them. Texts are then
compared as ordered lists of identifiers. Only identifiers and digests are moved, never texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demand_engine.session import cut_lineage

LEAST, MOST = 256, 8192
#: Where a cut may be: its end. The choice of characters is arbitrary.
_CUT = r"[adhl0-3][nrst4-7]\s"


def chunks(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """The content-defined chunks of a text, in order; joined they are the text. None for null or empty."""
    pattern = rf"(?s).{{{least},{most}}}?{_CUT}|.{{1,{most}}}"
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_sha256, ids, digests) per row: the ordered chunk identifiers and their SHA-256."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    cut = docs.select(F.col(id_col).alias("doc_id"), F.sha2(text, 256).alias("text_sha256"), chunks(text).alias("cut"))
    return cut.select(
        "doc_id",
        "text_sha256",
        F.transform("cut", lambda c: F.xxhash64(c)).alias("ids"),
        F.transform("cut", lambda c: F.unhex(F.sha2(c, 256))).alias("digests"),
    )


def chunk_table(made: DataFrame) -> DataFrame:
    """(id, digest, uses): the distinct chunks of all recipes; an id with two digests has two rows."""
    each = made.select(F.explode(F.arrays_zip(F.col("ids").alias("id"), F.col("digests").alias("digest"))).alias("c"))
    return each.groupBy(F.col("c.id").alias("id"), F.col("c.digest").alias("digest")).agg(F.count(F.lit(1)).alias("uses"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) per row of `docs`, dropped ones too.

    Texts are equal when identical; null counts as empty. Of equal texts the row with the largest
    id stays; rows that repeat that id and text can't be told apart and all stay. A null id is less
    than any other. Other columns are ignored; an empty table gives an empty result.

    An identifier that stands for two contents is expected once in 2^64 pairs of chunks; a recipe
    that holds one is compared by the digest of its whole text as well.
    """
    made = cut_lineage(recipes(docs, id_col, text_col))
    doubtful = chunk_table(made).groupBy("id").count().where(F.col("count") > 1)
    doubted = cut_lineage(doubtful.agg(F.collect_list("id").alias("ids")))
    exact = F.when(F.arrays_overlap("ids", doubted.scalar()), F.col("text_sha256")).otherwise(F.lit(""))
    keyed = made.select("doc_id", "text_sha256", "ids", exact.alias("exact"))
    groups = cut_lineage(
        keyed.groupBy("ids", "exact").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    return keyed.join(groups, ["ids", "exact"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
