"""The corpus pipeline: documents through the stages, each on all that its predecessor kept.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demand_engine.llm.contamination import contamination
from demand_engine.llm.jaccard import similar_documents
from demand_engine.llm.lines import dedup_lines, has_lines
from demand_engine.llm.pieces import Vocabulary, encode
from demand_engine.llm.quality import fit_quality, quality_scores
from demand_engine.session import cut_lineage

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of at least one half, by a model fitted on the labels."""
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality_scores(docs, model, tuple(docs.columns), "__score")
    return scored.where("__score >= 0.5").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier line nearly equals; those with only blank lines left go."""
    left = dedup_lines(docs, counts=True, equal_from=1)
    left = left.where(F.col("text").isNull() | (F.col("n_removed") == 0) | has_lines(F.col("text")))
    return left.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the least id; rows that share an id are one document."""
    groups = similar_documents(docs)
    firsts = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__first")).distinct()
    return docs.join(firsts, docs["doc_id"].eqNullSafe(firsts["__first"]), "left_semi")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark passage."""
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hit = found.where("contaminated").select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct()
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["__id"]) & (F.xxhash64(docs["text"]) == hit["__key"]), "left_anti")


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_chars, ids): the piece ids of every text."""
    return encode(docs, Vocabulary.load(VOCABULARY), ("doc_id", "lang", "source", "n_chars"))


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding", encode_texts),
]

#: Model scores, edit distances and pieces have no SQL; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
