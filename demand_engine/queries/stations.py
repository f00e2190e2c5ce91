"""Station names, versions and attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demand_engine.functions.names import (
    clean_station_name,
    gender,
    replace_literals,
    title_case,
    user_type,
)
from demand_engine.operators import stations as S
from demand_engine.operators.joins import left_lookup
from demand_engine.operators.tables import (
    add_absent,
    rename_known,
    rename_required,
    union_relaxed,
)
from demand_engine.queries.registry import query
from demand_engine.queries.views import (
    clean_sql,
    literals_sql,
    mapped_sql,
    sql,
    station_table,
    stations,
    table,
    trips,
    version,
)
from demand_engine.functions import names


@query(
    sql(
        f"""SELECT station_id, station_version, station_name,
            {clean_sql("station_name")} AS clean_station_name FROM stations""",
        "stations",
    )
)
def clean_station_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stations(spark, sf_dir).select(
        "station_id",
        "station_version",
        "station_name",
        clean_station_name(F.col("station_name")).alias("clean_station_name"),
    )


@query(f"SELECT c_custkey, {literals_sql('c_name')} AS replaced FROM customer")
def literal_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", replace_literals(F.col("c_name")).alias("replaced")
    )


@query(sql("SELECT * FROM station_map", "station_map"))
def station_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.station_map(stations(spark, sf_dir))


@query(sql("SELECT * FROM clean_stations", "clean_stations"))
def normalize_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stations(spark, sf_dir)
    return S.normalize_stations(rows, S.station_map(rows))


@query(
    sql(
        "SELECT ride_id, start_station_name, end_station_name FROM normal_trips", "normal_trips"
    )
)
def normalize_trip_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = S.station_map(station_table(spark, sf_dir))
    named = S.map_names(trips(spark, sf_dir), "start_station_name", known)
    return S.map_names(named, "end_station_name", known).select(
        "ride_id", "start_station_name", "end_station_name"
    )


@query(
    sql(
        f"SELECT ride_id, {mapped_sql('user_type', names.USER_TYPES)} AS user_type FROM trips",
        "trips",
    )
)
def user_type_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips(spark, sf_dir).select("ride_id", user_type(F.col("user_type")).alias("user_type"))


@query(
    sql(
        f"SELECT ride_id, {mapped_sql('cast(gender AS varchar)', names.GENDERS)} AS gender FROM trips",
        "trips",
    )
)
def gender_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips(spark, sf_dir).select("ride_id", gender(F.col("gender")).alias("gender"))


@query(
    """SELECT o_orderkey, CASE WHEN used >= TIMESTAMP '2019-10-30' THEN 2
        WHEN used >= TIMESTAMP '2017-07-01' THEN 1 ELSE 0 END AS station_version
    FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL 20 YEAR END AS used
          FROM orders)"""
)
def station_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates twenty years on fall around the real validity dates; open orders have none."""
    used = F.expr("CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL 20 YEAR END")
    return table(spark, sf_dir, "orders").withColumn("used", used).select(
        "o_orderkey", S.station_version("used")
    )


@query(
    """WITH validity AS (SELECT date_trunc('year', o_orderdate) AS effective_from,
            year(o_orderdate) - 1995 AS station_version FROM orders
            GROUP BY ALL)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
        cast(coalesce(station_version, (SELECT min(station_version) FROM validity)) AS int)
            AS station_version
    FROM lineitem ASOF LEFT JOIN validity ON l_shipdate >= effective_from"""
)
def station_version_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validity dates from a table: the first day of each order year, applied to ship dates."""
    year = F.year("o_orderdate")
    validity = (
        table(spark, sf_dir, "orders")
        .select(
            F.date_trunc("year", "o_orderdate").cast("timestamp_ntz").alias("effective_from"),
            (year - 1995).alias("station_version"),
        )
    )
    return S.version_as_of(table(spark, sf_dir, "lineitem"), "l_shipdate", validity).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "station_version"
    )


@query(
    sql(
        """SELECT t.ride_id, t.start_station_name, t.end_station_name,
            a.total_docks AS start_station_total_docks, a.public AS start_station_public,
            a.district AS start_district, b.total_docks AS end_station_total_docks,
            b.public AS end_station_public, b.district AS end_district
        FROM trips t
        LEFT JOIN stations a ON a.station_name = t.start_station_name AND a.station_version = 2
        LEFT JOIN stations b ON b.station_name = t.end_station_name AND b.station_version = 2""",
        "trips",
        "stations",
    )
)
def trips_with_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join alone, on raw names and one version for all."""
    versioned = trips(spark, sf_dir).select(
        "ride_id",
        "start_station_name",
        "end_station_name",
        F.lit(2).alias("start_station_version"),
        F.lit(2).alias("end_station_version"),
    )
    attributes = stations(spark, sf_dir).select(*S.STATION_ATTRIBUTES)
    return S.attach_stations(versioned, attributes).drop(
        "start_station_version", "end_station_version"
    )


@query(sql("SELECT * FROM standard_trips", "standard_trips"))
def standardize_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.standardize(trips(spark, sf_dir), station_table(spark, sf_dir), version)


@query(
    sql(
        """SELECT t.* REPLACE (CASE WHEN ride_id % 3 = 0 THEN (SELECT min(station_name) FROM stations) ELSE start_station_name END
            AS start_station_name), s.total_docks, s.district
        FROM trips t LEFT JOIN stations s ON s.station_name
            = CASE WHEN ride_id % 3 = 0 THEN (SELECT min(station_name) FROM stations) ELSE start_station_name END""",
        "trips",
        "stations",
    )
)
def spread_station_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join for a dimension too large to broadcast; a third of the trips starts at one station."""
    lists = stations(spark, sf_dir)
    busy = F.when(F.col("ride_id") % 3 == 0, lists.agg(F.min("station_name")).scalar()).otherwise(F.col("start_station_name"))
    docks = lists.select(F.col("station_name").alias("start_station_name"), "total_docks", "district")
    rows = trips(spark, sf_dir).withColumn("start_station_name", busy)
    return left_lookup(rows, docks, ["start_station_name"], max_rows=0)


@query(
    sql(
        """SELECT station_name, station_version, count(*) AS copies FROM clean_stations
        GROUP BY 1, 2 HAVING count(*) > 1""",
        "clean_stations",
    )
)
def duplicate_station_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.duplicate_stations(stations(spark, sf_dir))


_TITLE = """array_to_string(list_transform(regexp_extract_all({0}, '[a-zA-Z0-9]+|[^a-zA-Z0-9]+'),
    lambda w: upper(w[1]) || lower(w[2:])), '')"""


@query(
    sql(
        f"SELECT station_id, station_version, station_name, {_TITLE.format('station_name')} AS title FROM stations",
        "stations",
    )
)
def station_titlecase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stations(spark, sf_dir).select(
        "station_id",
        "station_version",
        "station_name",
        title_case(F.col("station_name")).alias("title"),
    )


@query(
    """SELECT s_suppkey AS account, s_name AS name, s_acctbal AS balance, NULL::varchar AS segment
    FROM supplier UNION ALL
    SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer"""
)
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Renames, an absent column, and a union by name of two tables."""
    old = rename_known(
        table(spark, sf_dir, "supplier").drop("s_nationkey"),
        {"s_suppkey": "account", "s_name": "name", "s_acctbal": "balance", "S_NAME": "unused"},
    )
    new = rename_required(
        table(spark, sf_dir, "customer").drop("c_nationkey"),
        {
            "c_custkey": "account",
            "c_name": "name",
            "c_acctbal": "balance",
            "c_mktsegment": "segment",
        },
    )
    return union_relaxed([old, new])


@query(
    """SELECT cast(p_size AS varchar) AS code, p_partkey AS id FROM part
    UNION ALL SELECT o_orderpriority, o_orderkey FROM orders"""
)
def union_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers and texts under one name widen to text."""
    sizes = table(spark, sf_dir, "part").select(
        F.col("p_size").alias("code"), F.col("p_partkey").alias("id")
    )
    priorities = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("code"), F.col("o_orderkey").alias("id")
    )
    return union_relaxed([sizes, priorities])


@query("SELECT event_id, value AS temp, NULL::double AS dwpt, NULL::double AS coco FROM events")
def missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", F.col("value").alias("temp"))
    return add_absent(rows, {"temp": "double", "dwpt": "double", "coco": "double"})
