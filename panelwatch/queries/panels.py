"""Daily and event panels derived from the given tables, in Spark and in SQL.

Two-digit amounts are summed as whole cents, so that a sum does not depend on row
order (a cast to decimal would, per row, cost more than all the rest).  Facts
collapse to one row per (key, day) in a partial aggregate before any shuffle,
so a hot key costs no more than its number of days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwatch.sources.landing import with_staleness

AS_OF = "2001-11-10"
FLOOR = "1996-01-01"


TABLES = {
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table under its declared schema, which saves a job to infer it."""
    return spark.read.schema(TABLES[name]).parquet(f"{sf}/{name}.parquet")


def cents(c: str) -> Column:
    return F.rint(F.col(c) * 100.0).cast("long")


def total(c: Column) -> Column:
    """The sum of a column of cents, as the double nearest to the exact amount."""
    return F.sum(c) / F.lit(100.0)


# -- ship: shipped value per supplier nation and day ---------------------------


def ship(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_suppkey", "l_shipdate", "l_extendedprice")
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    return (
        lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(F.col("s_nationkey").alias("series_key"), F.col("l_shipdate").cast("date").alias("date"))
        .agg(total(cents("l_extendedprice")).alias("value"))
    )


SHIP = """
ship AS (
  SELECT s_nationkey AS series_key, CAST(l_shipdate AS DATE) AS date,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  GROUP BY 1, 2
)"""

# -- ord: order value per priority and day --------------------------------------


def ord_(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "orders")
        .groupBy(F.col("o_orderpriority").alias("series_key"), F.col("o_orderdate").cast("date").alias("date"))
        .agg(total(cents("o_totalprice")).alias("value"))
    )


ORD = """
ord AS (
  SELECT o_orderpriority AS series_key, CAST(o_orderdate AS DATE) AS date,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM orders GROUP BY 1, 2
)"""

# -- evt: single events per type, unbounded per key ------------------------------


def evt(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_type").alias("series_key"), "ts", "event_id", "value"
    )


EVT = """
evt AS (SELECT event_type AS series_key, ts, event_id, value FROM events)"""
EVT_ORDER = {"part": "series_key", "order": "ts, event_id"}

# -- the regional market: all inputs of the feature sets --------------------------


def _by_region(facts: DataFrame, spark: SparkSession, sf: str, owner: str, key: str, fact_key: str, nation: str):
    owners = table(spark, sf, owner).select(key, nation)
    nations = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    return (
        facts.join(owners, F.col(fact_key) == F.col(key))
        .join(nations, F.col(nation) == F.col("n_nationkey"))
        .withColumnRenamed("n_regionkey", "series_key")
    )


def shipments(spark: SparkSession, sf: str) -> DataFrame:
    """One row per (region, day): price-like and index-like series of the shipped lines."""
    lines = table(spark, sf, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"
    )
    price, n = cents("l_extendedprice"), F.count(F.lit(1))
    mean = lambda c: total(c) / n
    is_o = F.col("l_linestatus") == "O"
    return (
        _by_region(lines, spark, sf, "supplier", "s_suppkey", "l_suppkey", "s_nationkey")
        .groupBy("series_key", F.col("l_shipdate").cast("date").alias("date"))
        .agg(
            total(F.when(F.col("l_returnflag") == "A", price)).alias("BZ=F"),
            total(price).alias("CL=F"),
            total(cents("l_quantity")).alias("NG=F"),
            mean(price).alias("XLE"),
            F.max("l_extendedprice").alias("XOP"),
            (mean(cents("l_discount")) * 100.0).alias("^OVX"),
            (mean(cents("l_tax")) * 100.0).alias("^VIX"),
            total(F.when(is_o, cents("l_quantity"))).alias("GPR_AI"),
            F.max(F.when(is_o, F.col("l_extendedprice"))).alias("GPR_OIL"),
        )
    )


def prices_of(shipped: DataFrame) -> DataFrame:
    return shipped.drop("GPR_AI", "GPR_OIL")


def geo_of(shipped: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """Days with open lines only, so this source has a spine of its own."""
    geo = shipped.select("series_key", "date", "GPR_AI", "GPR_OIL").filter(F.col("GPR_AI").isNotNull())
    return with_staleness(geo, as_of)


def macro(spark: SparkSession, sf: str) -> DataFrame:
    """One row per (region, order day): dense and sparse series of the orders."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    price, n = cents("o_totalprice"), F.count(F.lit(1))
    of = lambda p: total(F.when(F.col("o_orderpriority") == p, price))
    return (
        _by_region(orders, spark, sf, "customer", "c_custkey", "o_custkey", "c_nationkey")
        .groupBy("series_key", F.col("o_orderdate").cast("date").alias("date"))
        .agg(
            (total(price) / n).alias("fed_rate"),
            of("1-URGENT").alias("yield_curve"),
            F.max("o_totalprice").alias("dxy"),
            F.min("o_totalprice").alias("hy_spread"),
            of("5-LOW").alias("cpi"),
            total(price).alias("brent"),
        )
    )


MARKET = """
shipments AS (
  SELECT n_regionkey AS series_key, CAST(l_shipdate AS DATE) AS date,
         CAST(sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS bz,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS cl,
         CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS ng,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS xle,
         CAST(max(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS xop,
         CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / count(*) * 100.0::DOUBLE AS ovx,
         CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) / count(*) * 100.0::DOUBLE AS vix,
         CAST(sum(CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS DECIMAL(18,2)) END) AS DOUBLE) AS gpr_ai,
         CAST(max(CASE WHEN l_linestatus = 'O' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS gpr_oil
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY 1, 2
),
macro AS (
  SELECT n_regionkey AS series_key, CAST(o_orderdate AS DATE) AS date,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS fed_rate,
         CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS yield_curve,
         CAST(max(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS dxy,
         CAST(min(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS hy_spread,
         CAST(sum(CASE WHEN o_orderpriority = '5-LOW' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS cpi,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS brent
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2
)"""
