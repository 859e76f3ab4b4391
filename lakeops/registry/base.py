"""Query registration and the stand-in views of the test tables.

Each query is registered with the SQL an independent engine runs on the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeops.functions.clock import epoch_seconds

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


#: Rules of the typology queries: most occurrences, fewest days, most days, label.
TYPES = ((0, 0, None, "none"), (2, 0, 4, "few short"), (2, 5, None, "few long"), (6, 0, None, "some"))


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def money(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(18,2)")


def second_of_day(column: str) -> Column:
    return F.hour(column) * 3600 + F.minute(column) * 60 + F.second(column)


def passages(spark: SparkSession, folder: str) -> DataFrame:
    """Stop passages: line, stop, trip (entity and day), planned second and deviation."""
    return table(spark, folder, "events").select(
        "event_id",
        "ts",
        "user_id",
        F.col("ts").cast("date").alias("day"),
        F.col("event_type").alias("line"),
        (F.col("user_id") % 20).alias("stop"),
        epoch_seconds(F.col("ts")).alias("planned_s"),
        F.round((F.col("value") - 50) * 6).cast("int").alias("deviation_s"),
    )


PASSAGES = """passages AS (
  SELECT event_id, ts, user_id, CAST(ts AS DATE) AS day, event_type AS line, user_id % 20 AS stop,
         epoch_us(ts) // 1000000 AS planned_s, CAST(round((value - 50) * 6) AS INT) AS deviation_s
  FROM events)"""


def panel(spark: SparkSession, folder: str) -> DataFrame:
    """One row per entity and day: any error, most frequent event type (ties by name)."""
    typed = (
        table(spark, folder, "events")
        .groupBy(F.col("user_id").alias("entity"), F.col("ts").cast("date").alias("day"), "event_type")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(money("value")).alias("amount"))
    )
    return typed.groupBy("entity", "day").agg(
        F.max(F.when(F.col("event_type") == "error", 1).otherwise(0)).alias("flag"),
        F.sum("n").alias("n_events"),
        F.sum("amount").cast("decimal(18,2)").alias("amount"),
        F.min_by("event_type", F.struct(-F.col("n"), F.col("event_type"))).alias("kind"),
    )


PANEL = """typed AS (
  SELECT user_id AS entity, CAST(ts AS DATE) AS day, event_type, count(*) AS n,
         sum(CAST(value AS DECIMAL(18,2))) AS amount
  FROM events GROUP BY 1, 2, 3),
panel AS (
  SELECT entity, day, max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS flag,
         CAST(sum(n) AS BIGINT) AS n_events, CAST(sum(amount) AS DECIMAL(18,2)) AS amount,
         first(event_type ORDER BY n DESC, event_type) AS kind
  FROM typed GROUP BY 1, 2)"""


def sales(spark: SparkSession, folder: str) -> DataFrame:
    """Sale lines with partly missing validity."""
    shipped = F.col("l_shipdate").cast("date")
    return table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("product"),
        shipped.alias("sold_on"),
        F.when(F.col("l_returnflag") == "A", F.date_add(shipped, 10))
        .when(F.col("l_returnflag") == "R", F.date_sub(shipped, 20))
        .alias("valid_from"),
        F.when(F.col("l_linestatus") == "F", F.date_add(shipped, 40)).alias("valid_to"),
        F.col("l_quantity").cast("long").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_extendedprice").alias("amount"),
        F.round(F.col("l_tax") * 100).alias("vat_rate"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    family = (
        F.when(F.col("p_type").isin("ECONOMY", "LARGE"), "annual")
        .when(F.col("p_type").isin("MEDIUM", "PROMO"), "monthly")
        .otherwise("occasional")
    )
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product"),
        F.col("p_brand").alias("account"),
        family.alias("family"),
        F.when(F.col("p_size") <= 40, F.col("p_size")).alias("trips_per_unit"),
    )


def accounts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(F.col("p_brand").alias("account")).distinct()


SALE_LINES = """sales AS (
  SELECT l_partkey AS product, CAST(l_shipdate AS DATE) AS sold_on,
         CASE l_returnflag WHEN 'A' THEN CAST(l_shipdate AS DATE) + 10
                           WHEN 'R' THEN CAST(l_shipdate AS DATE) - 20 END AS valid_from,
         CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) + 40 END AS valid_to,
         CAST(l_quantity AS BIGINT) AS quantity, l_extendedprice AS price, l_extendedprice AS amount,
         round(l_tax * 100) AS vat_rate
  FROM lineitem),
products AS (
  SELECT p_partkey AS product, p_brand AS account,
         CASE WHEN p_type IN ('ECONOMY', 'LARGE') THEN 'annual'
              WHEN p_type IN ('MEDIUM', 'PROMO') THEN 'monthly' ELSE 'occasional' END AS family,
         CASE WHEN p_size <= 40 THEN p_size END AS trips_per_unit
  FROM part),
anchored AS (
  SELECT s.*, p.account, p.family, coalesce(p.trips_per_unit, 1) * s.quantity AS trips,
         CASE WHEN valid_from IS NULL OR valid_from < sold_on THEN sold_on ELSE valid_from END AS anchor
  FROM sales s LEFT JOIN products p USING (product)),
lines AS (
  SELECT *, coalesce(valid_from, sold_on) AS plain_from,
         CASE WHEN valid_to IS NULL AND family = 'annual' THEN CAST(sold_on + INTERVAL 11 MONTH AS DATE)
              WHEN valid_to IS NULL AND family = 'monthly' THEN last_day(sold_on)
              WHEN valid_to IS NULL THEN sold_on ELSE valid_to END AS plain_to,
         CASE WHEN family = 'annual' THEN CAST(date_trunc('month', anchor) AS DATE)
              ELSE coalesce(valid_from, sold_on) END AS aligned_from,
         CASE WHEN family = 'annual' THEN last_day(CAST(date_trunc('month', anchor) + INTERVAL 11 MONTH AS DATE))
              WHEN valid_to IS NULL AND family = 'monthly' THEN last_day(sold_on)
              WHEN valid_to IS NULL THEN sold_on ELSE valid_to END AS aligned_to,
         CASE WHEN family = 'annual' THEN price / 12 ELSE price END AS business_price
  FROM anchored)"""


def chain_points(spark: SparkSession, folder: str) -> DataFrame:
    """Points of a chain: the smallest part per (order, line number)."""
    return (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("chain"), F.col("l_linenumber").alias("point_order"))
        .agg(F.min("l_partkey").alias("point"), F.sum(F.col("l_quantity").cast("long")).alias("length"))
    )


CHAIN_POINTS = """chain_points AS (
  SELECT l_orderkey AS chain, l_linenumber AS point_order, min(l_partkey) AS point,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS length
  FROM lineitem GROUP BY 1, 2)"""
