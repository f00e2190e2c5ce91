"""Benchmark passages in documents: an exact containment join on words, in DataFrame functions only.

Every item is cut into windows of consecutive words. A window occurs where all of its words stand in
order, so its containment prefix is one word: the rarest of its words in the whole corpus. Documents
meet windows on that word; the place of the word in the window bounds where the window would begin
and end, and the words there are compared with all of the window.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demand_engine.session import cut_lineage

WINDOW = 10
#: Windows broadcast at once; a larger benchmark takes one pass over the documents per block of so many.
BLOCK_WINDOWS = 500_000

_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def _split(text: Column) -> Column:
    """Words in order; text that begins or ends with a separator has an empty string there."""
    return F.split(F.coalesce(text, F.lit("")), _SEPARATORS)


def _count(words: Column) -> Column:
    """Words of a split text, without the empty strings at its ends."""
    first, last = (F.element_at(words, F.lit(i)) == "" for i in (1, -1))
    return F.greatest(F.size(words) - first.cast("int") - last.cast("int"), F.lit(0)).cast("bigint")


def windows(items: DataFrame, width: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(window, size, items): the distinct windows and the ids of the items that hold them.

    An item of fewer words than `width`, but not none, is one window. A null id marks words but is
    not listed.
    """
    words = F.filter(_split(_lowered(F.col(text_col))), lambda w: w != "")
    each = items.select(F.col(id_col).alias("item_id"), words.alias("words")).where(F.size("words") > 0)
    each = each.withColumn("size", F.least(F.size("words"), F.lit(width)))
    each = each.withColumn("at", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1)))
    text = F.array_join(F.slice("words", F.col("at"), F.col("size")), " ")
    return each.groupBy(text.alias("window"), "size").agg(F.collect_set("item_id").alias("items"))


def _prefixes(found: DataFrame, documents: DataFrame) -> DataFrame:
    """(token, ahead, window, size, items): windows whose words all occur, by their rarest word."""
    words = found.select("window", "size", "items", F.posexplode(F.split("window", " ")).alias("ahead", "word"))
    words = cut_lineage(words.withColumn("word", F.lower("word")))
    vocabulary = words.select("word").distinct()
    said = documents.select(F.explode(_split(F.col("text"))).alias("word")).select(F.lower("word").alias("word"))
    counts = said.join(F.broadcast(vocabulary), "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("uses"))
    rarest = F.min(F.struct(F.coalesce("uses", F.lit(0)).alias("uses"), "word", "ahead"))
    best = words.join(counts, "word", "left").groupBy("window", "size", "items").agg(rarest.alias("best"))
    return best.where("best.uses > 0").select(
        F.col("best.word").alias("token"), F.col("best.ahead").alias("ahead"), "window", "size", "items"
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    width: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, text_key) per row of `docs`.

    Words are runs of ASCII letters and digits, A-Z in lower case, and of all other characters
    beyond ASCII. A word inside any occurrence of a window is hit. Null has no words. Rows that
    repeat an id and a text give equal rows; `text_key` is xxhash64 of the text. Other columns are ignored. Without items nothing is
    hit; without documents the result is empty.
    """
    found = cut_lineage(windows(items, width))
    blocks = max(1, math.ceil(found.count() / block_windows))
    documents = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    parts = []
    for block in range(blocks):
        part = found.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == block) if blocks > 1 else found
        parts.append(_occurrences(documents, cut_lineage(_prefixes(part, documents))))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part.withColumn("copies", F.lit(0)))
    spans = F.collect_set(F.when(F.col("size").isNotNull(), F.struct("begin", "size")))
    per_text = whole.groupBy("doc_id", "text_key", "n_words").agg(
        F.sum("copies").alias("copies"), spans.alias("spans"), F.flatten(F.collect_set("items")).alias("named")
    )
    covered = F.flatten(F.transform("spans", lambda s: F.sequence(s["begin"], s["begin"] + s["size"] - 1)))
    listed = F.array_sort(F.array_distinct(F.transform("named", lambda i: i.cast("string"))))
    result = per_text.select(
        "doc_id",
        "n_words",
        F.size(F.array_distinct(covered)).cast("bigint").alias("n_hit"),
        F.size(listed).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        "text_key",
        "copies",
    )
    return result.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copy", "copies")


def _occurrences(documents: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The places where windows occur, and for each row of the documents one line with `copies` 1."""
    words = documents.select("doc_id", F.xxhash64("text").alias("text_key"), _split(F.col("text")).alias("words"))
    ended = F.concat("words", F.array(F.lit(None).cast("string")))  # the null closes the row and meets nothing
    each = words.select("doc_id", "text_key", "words", F.posexplode(ended).alias("at", "word"))
    begin = F.col("at") - F.col("ahead")
    inside = (begin >= 0) & (begin + F.col("size") <= F.size("words"))
    text = _lowered(F.array_join(F.slice("words", F.greatest(begin, F.lit(0)) + 1, F.col("size")), " "))
    met = each.join(F.broadcast(prefixes), (F.lower("word") == F.col("token")) & inside & (text == F.col("window")), "left")
    return met.where(F.col("token").isNotNull() | F.col("word").isNull()).select(
        "doc_id",
        "text_key",
        _count(F.col("words")).alias("n_words"),
        begin.alias("begin"),
        "size",
        "items",
        F.col("word").isNull().cast("int").alias("copies"),
    )
