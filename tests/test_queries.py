"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from demand_engine.queries import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
ROWS_ONLY = {"train_and_score", "model_report"}


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    return con


def text(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
        return "null"
    if isinstance(value, pd.Timestamp):
        return str(value.to_pydatetime())
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, bool):
        return str(value)
    return repr(float(value)) if isinstance(value, (int, float)) else str(value)


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(text(v) for v in r) for r in frame.itertuples(index=False, name=None))


def test_every_query_has_sql_or_is_a_model():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_flagship(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["datetime", "station", "demand"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, small, name):
    got = contract.queries()[name](spark, small).toPandas()
    expected = duck.sql(contract.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows(got) == rows(expected)


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_model_query_runs(spark, small, name):
    assert contract.queries()[name](spark, small).count() > 0
