"""Inputs derived from the given tables, once as DataFrame and once as SQL.

The tables hold no nulls, markers or duplicates, so these are put in by the same
key arithmetic on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import table


def lineitem_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem measures with nulls: qty 1 in 7, disc 1 in 11, ghost 19 in 20, flag 1 in 13."""
    k, ln = F.col("l_orderkey"), F.col("l_linenumber")
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (k * 10 + ln).alias("rowkey"),
        F.col("l_extendedprice").alias("price"),
        F.when(k % 7 != 0, F.col("l_quantity")).alias("qty"),
        F.when(k % 11 != 0, F.col("l_discount")).alias("disc"),
        F.when((k + ln) % 20 == 0, F.col("l_tax")).alias("ghost"),
        F.when(k % 13 != 0, F.col("l_returnflag")).alias("flag"),
        F.col("l_linestatus").alias("status"),
    )


LINEITEM_NULLS = """(SELECT l_orderkey, l_linenumber, l_orderkey * 10 + l_linenumber AS rowkey, l_extendedprice AS price,
  CASE WHEN l_orderkey % 7 <> 0 THEN l_quantity END AS qty,
  CASE WHEN l_orderkey % 11 <> 0 THEN l_discount END AS disc,
  CASE WHEN (l_orderkey + l_linenumber) % 20 = 0 THEN l_tax END AS ghost,
  CASE WHEN l_orderkey % 13 <> 0 THEN l_returnflag END AS flag,
  l_linestatus AS status FROM lineitem)"""


def events_mixed(spark: SparkSession, sf: str) -> DataFrame:
    """events with a mostly numeric text column, a marker and a truth word."""
    k = F.col("event_id")
    return table(spark, sf, "events").select(
        "event_id",
        "ts",
        "value",
        F.when(k % 20 == 0, "na").otherwise(F.col("user_id").cast("string")).alias("mixed"),
        F.when(k % 10 == 0, "?").otherwise(F.col("event_type")).alias("marked"),
        F.when(k % 3 == 0, "Yes").otherwise("no").alias("truth"),
        F.lit("same").alias("fixed"),
    )


EVENTS_MIXED = """(SELECT event_id, ts, value,
  CASE WHEN event_id % 20 = 0 THEN 'na' ELSE CAST(user_id AS VARCHAR) END AS mixed,
  CASE WHEN event_id % 10 = 0 THEN '?' ELSE event_type END AS marked,
  CASE WHEN event_id % 3 = 0 THEN 'Yes' ELSE 'no' END AS truth,
  'same' AS fixed FROM events)"""


def events_untimed(spark: SparkSession, sf: str) -> DataFrame:
    """events whose time is unknown 1 in 17."""
    return table(spark, sf, "events").withColumn("ts", F.when(F.col("event_id") % 17 != 0, F.col("ts")))


EVENTS_UNTIMED = "(SELECT * REPLACE (CASE WHEN event_id % 17 <> 0 THEN ts END AS ts) FROM events)"


def orders_twice(spark: SparkSession, sf: str) -> DataFrame:
    """orders with some rows repeated."""
    o = table(spark, sf, "orders")
    return o.unionByName(o.filter(F.col("o_orderkey") % 50 == 0))


ORDERS_TWICE = "(SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 50 = 0)"


def orders_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """orders with a unique rowkey and nulls: qty 1 in 7, disc 1 in 11, flag 1 in 13."""
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        k.alias("rowkey"),
        F.col("o_totalprice").alias("price"),
        F.when(k % 7 != 0, F.dayofmonth(d).cast("double")).alias("qty"),
        F.when(k % 11 != 0, F.month(d) / 100).alias("disc"),
        F.when(k % 13 != 0, F.col("o_orderpriority")).alias("flag"),
        F.col("o_orderstatus").alias("status"),
    )


ORDERS_NULLS = """(SELECT o_orderkey AS rowkey, o_totalprice AS price,
  CASE WHEN o_orderkey % 7 <> 0 THEN day(o_orderdate)::DOUBLE END AS qty,
  CASE WHEN o_orderkey % 11 <> 0 THEN month(o_orderdate)::DOUBLE / 100 END AS disc,
  CASE WHEN o_orderkey % 13 <> 0 THEN o_orderpriority END AS flag,
  o_orderstatus AS status FROM orders)"""
