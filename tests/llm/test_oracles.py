"""The registered document queries against their SQL, and the pipeline's contract."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from demand_engine.llm.queries import ORACLES, QUERIES

TABLES = "documents embeddings pages benchmark labels conversations".split()


def rows(frame, columns):
    return sorted(tuple("null" if pd.isna(v) else str(int(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v in r) for r in frame[columns].astype(object).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, small, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    expected = con.execute(ORACLES[name]).df()
    got = QUERIES[name](spark, small).toPandas()
    assert sorted(got.columns) == sorted(expected.columns)
    columns = sorted(expected.columns)
    assert rows(got, columns) == rows(expected, columns)


def test_all_are_registered_and_the_pipeline():
    names = contract.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert names["pipeline"] is corpus_pipeline.run


def test_pipeline_keeps_columns_and_ends_with_ids(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, kept = docs.columns, docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = kept.count()
        kept = spark.createDataFrame(stage(spark, kept, small).toPandas(), docs.schema)
        assert kept.columns == columns
        assert 0 < kept.count() <= before
    assert corpus_pipeline.STAGES[-1][1](spark, kept, small).where("size(ids) = 0 and n_chars > 0").count() == 0
