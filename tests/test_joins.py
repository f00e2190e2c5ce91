import random

import pytest
from pyspark.sql import functions as F

from demand_engine.operators.joins import Size, left_lookup, measure


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of the rows, another third has no key."""
    facts = spark.range(9000).select(
        F.col("id").alias("ride"),
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 700))
        .alias("name"),
        (F.col("id") % 2).alias("version"),
    )
    dim = spark.range(600).select(
        F.when(F.col("id") < 3, F.lit("hot")).otherwise(F.concat(F.lit("k"), "id")).alias("name"),
        (F.col("id") % 2).alias("version"),
        F.col("id").alias("docks"),
    )
    return facts.repartition(6), dim


def test_size_is_exact(spark):
    df = spark.createDataFrame([("ab", 1), (None, 2)], "s string, n bigint")
    assert measure(df) == Size(rows=2, bytes=2 + 16 + 16 + 16 + 16)
    assert measure(df.where("n > 5")) == Size(rows=0, bytes=0)


def test_small_side_is_broadcast_and_left_side_stays_in_place(skewed):
    facts, dim = skewed
    joined = left_lookup(facts, dim, ["name", "version"])
    plan = plan_of(joined)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_large_side_is_not_broadcast_and_rows_are_the_same(skewed):
    facts, dim = skewed
    plain = facts.join(dim, ["name", "version"], "left")
    spread = left_lookup(facts, dim, ["name", "version"], max_rows=10)
    assert "SortMergeJoin" in plan_of(spread)
    assert rows_of(spread.select(plain.columns)) == rows_of(plain)


SPLIT = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.mark.parametrize("name", ["hot", None])
def test_a_hot_key_and_no_key_are_split_over_tasks(spark, name):
    """A third of the rows. Spark splits by bytes, so that rows which compress to nothing stay together."""
    rng = random.Random(4)
    notes = ["".join(rng.choices("abcdefgh", k=20)) for _ in range(30_000)]
    facts = spark.createDataFrame([(name if k % 3 == 0 else f"k{k % 600}", note) for k, note in enumerate(notes)], "name string, note string").repartition(12)
    dim = spark.createDataFrame([("hot", 1), *((f"k{k}", k) for k in range(600))], "name string, docks int")
    before = {k: spark.conf.get(k) for k in SPLIT}
    for k, v in SPLIT.items():
        spark.conf.set(k, v)
    try:
        joined = left_lookup(facts, dim, ["name"], max_rows=0).withColumn("task", F.spark_partition_id()).toPandas()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    own = joined[joined["name"].isna() if name is None else joined["name"] == name]
    assert len(joined) == 30_000 and len(own) == 10_000 and own["docks"].isna().all() == (name is None)
    assert own["task"].nunique() > 1 and own.groupby("task").size().max() < 8_000


def test_shared_names_get_a_suffix(spark):
    left = spark.createDataFrame([(1, "l")], "k int, temp string")
    right = spark.createDataFrame([(1, "r")], "k int, temp string")
    got = left_lookup(left, right, ["k"])
    assert got.columns == ["k", "temp", "temp_right"]
    assert tuple(got.first()) == (1, "l", "r")
    with pytest.raises(ValueError, match="share a name"):
        left_lookup(left.withColumn("temp_right", F.lit(0)), right, ["k"])
