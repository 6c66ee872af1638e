"""Tables in the roles the queries use them in."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Query(NamedTuple):
    """A query and, where SQL can express it, the SQL with the same result."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def r6(column: Column | str, digits: int = 6) -> Column:
    """Rounded, so that the order in which tasks add up cannot show."""
    return F.round(column, digits)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def shipments(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with their orders."""
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


SHIPMENTS_SQL = "SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey"


def trips(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as trips from the supplier's nation to the customer's nation."""
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("dest")
    )
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("origin")
    )
    return shipments(spark, folder).join(customers, "o_custkey").join(suppliers, "l_suppkey")


TRIPS_SQL = """
  SELECT l.*, o.*, c.c_nationkey AS dest, s.s_nationkey AS origin
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey"""


def purchases(spark: SparkSession, folder: str) -> DataFrame:
    """Edges customer -> supplier, weighted by line items; some suppliers sell, none buys."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(F.lit("c"), "o_custkey").alias("src"),
        F.concat(F.lit("s"), "l_suppkey").alias("dst"),
    )


PURCHASES_SQL = """
  SELECT 'c' || o_custkey AS src, 's' || l_suppkey AS dst, count(*) AS weight
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2"""


def gappy_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with nulls: no value on errors, no properties on users divisible by 50."""
    return table(spark, folder, "events").withColumns({
        "value": F.when(F.col("event_type") != "error", F.col("value")),
        "props": F.when(F.col("user_id") % 50 != 0, F.col("props")),
    })


GAPPY_SQL = """
  SELECT event_id, ts, user_id, event_type,
         CASE WHEN event_type <> 'error' THEN value END AS value,
         CASE WHEN user_id % 50 <> 0 THEN props END AS props
  FROM events"""
