"""Variants of operators that the other queries don't reach."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions import clock, coding
from lakeops.plans import service_quality as sq, topology
from lakeops.registry.base import CHAIN_POINTS, chain_points, passages, query, table
from lakeops.registry.timelines import PUNCTUAL
from lakeops.session import local_table, scratch_path
from lakeops.sources import files, ingest


@query(
    "punctuality_by_direction",
    f"""WITH {PUNCTUAL} SELECT event_id, CASE WHEN on_time = 1 AND line <> 'error' AND stop % 2 = 0 THEN 1 ELSE 0 END AS on_time,
      CASE WHEN rank_in_trip <= chain_stops - 2 AND on_time = 1 AND line <> 'error' AND stop % 2 = 0 THEN 1 ELSE 0 END AS on_time_reference FROM ranked""",
)
def punctuality_by_direction(spark, d):
    """On time only where the direction is one that counts."""
    allowed = (F.col("line") != "error") & (F.col("stop") % 2 == 0)
    out = sq.punctuality(passages(spark, d), ["user_id", "day"], ["ts", "event_id"], ["user_id"], "line", "deviation_s", allowed=allowed)
    return out.select("event_id", "on_time", "on_time_reference")


@query(
    "dataset_names",
    """SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'sales' WHEN page_id % 3 = 1 THEN 'below' ELSE 'above' END AS dataset_id FROM pages""",
)
def dataset_names(spark, d):
    """The name of a file decides where it has parts, else the longest root."""
    third, number = F.col("page_id") % 3, F.col("page_id").cast("string")
    path = F.when(third == 0, F.concat(F.lit("in/deep/Sales__"), number)).when(third == 1, F.concat(F.lit("in/deep/"), number)).otherwise(F.concat(F.lit("in/"), number))
    named = table(spark, d, "pages").select("page_id", F.concat(path, F.lit(".csv")).alias("file_path"))
    roots = local_table(spark, [("in/", "above"), ("in/deep", "below")], "root string, dataset_id string")
    return ingest.with_dataset(named, roots).select("page_id", "dataset_id")


@query(
    "time_texts",
    """SELECT event_id, printf('%02d:%02d', event_id % 24, event_id % 4 * 15) AS from_hours, printf('%02d:%02d', event_id % 86400 // 3600, event_id % 3600 // 60) AS from_seconds,
      printf('%02d:00', event_id % 24) AS from_text FROM events""",
)
def time_texts(spark, d):
    n = F.col("event_id")
    hours, text = (n % 24).cast("double") + (n % 4).cast("double") / 4, F.concat(F.lit(" "), F.lpad((n % 24).cast("string"), 2, "0"), F.lit(":00:59"))
    return table(spark, d, "events").select(
        "event_id", clock.time_of_day_text(hours, "hours").alias("from_hours"), clock.time_of_day_text(n % 86400, "seconds").alias("from_seconds"),
        clock.time_of_day_text(text, "text").alias("from_text"),
    )


@query(
    "read_by_extension",
    """SELECT unnest(['csv', 'json', 'parquet']) AS kind, count(*) AS rows, CAST(sum(n_nationkey) AS BIGINT) AS keys, max(n_name) AS last FROM nation
    UNION ALL SELECT 'txt', 0, NULL, 'no reader for .txt' FROM (SELECT count(*) FROM nation)""",
)
def read_by_extension(spark, d):
    """One reader by extension: delimited, JSON with types found in it, Parquet, and an error."""
    nation, root, out = table(spark, d, "nation").select("n_nationkey", "n_name"), scratch_path(spark, "by-extension"), None
    nation.write.option("header", "true").csv(f"{root}/n.csv")
    nation.write.json(f"{root}/n.json")
    nation.write.parquet(f"{root}/n.parquet")
    for kind in ("csv", "json", "parquet"):
        rows = files.read_any(spark, f"{root}/n.{kind}")
        counted = rows.agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("rows"), F.sum(F.col("n_nationkey").cast("long")).alias("keys"), F.max("n_name").alias("last"))
        out = counted if out is None else out.unionByName(counted)
    try:
        files.read_any(spark, f"{root}/n.txt")
    except ValueError as error:
        refused = nation.agg(F.lit("txt").alias("kind"), F.lit(0).cast("long").alias("rows"), F.lit(None).cast("long").alias("keys"), F.lit(str(error)).alias("last"))
        out = out.unionByName(refused)
    return out


@query(
    "one_hot_found",
    """SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS is_1_urgent, CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END AS is_2_high,
      CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1 ELSE 0 END AS is_3_medium, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 1 ELSE 0 END AS is_4_not_specified,
      CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END AS is_5_low FROM orders""",
)
def one_hot_found(spark, d):
    """The values are looked up first, then given."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    found = sorted(r[0] for r in coding.known_values(orders, "o_orderpriority").collect())  # a short list of codes
    return coding.one_hot(orders, "o_orderpriority", found, "is_").drop("o_orderpriority")


@query(
    "time_differences",
    """SELECT event_id, CAST(datepart('day', ts - TIMESTAMP '2023-12-31 12:30:00') AS INTEGER) AS days, CAST(datepart('hour', ts - TIMESTAMP '2023-12-31 12:30:00') AS INTEGER) AS hours,
      CAST(datepart('minute', ts - TIMESTAMP '2023-12-31 12:30:00') AS INTEGER) AS minutes FROM events""",
)
def time_differences(spark, d):
    """Two times apart as an interval of days to seconds."""
    apart = F.col("ts") - F.lit("2023-12-31 12:30:00").cast("timestamp_ntz")
    rows = table(spark, d, "events").select("event_id", apart.alias("apart"))
    return rows.select("event_id", *[F.extract(F.lit(part), F.col("apart")).cast("int").alias(f"{part.lower()}s") for part in ("DAY", "HOUR", "MINUTE")])


@query(
    "located_chain",
    f"""WITH {CHAIN_POINTS}, l AS (SELECT chain, point_order, point, coalesce(lag(point) OVER (PARTITION BY chain ORDER BY point_order), 0) AS previous_point FROM chain_points),
    v AS (SELECT max(CAST(o_orderkey AS BIGINT)) AS period FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '1996-06-01' AND CAST(o_orderdate AS DATE) + 100 >= DATE '1996-06-01')
    SELECT chain, point_order, point, previous_point, p_size AS x, CASE WHEN p_type LIKE 'E%' THEN 'T1' WHEN p_type LIKE 'S%' THEN 'T3' END AS line_code, period
    FROM l JOIN v ON chain % 7 <> period % 7 LEFT JOIN part ON point = p_partkey""",
)
def located_chain(spark, d):
    """Points with the previous one, coordinates and line code, of the chains valid in the period of a day."""
    on = F.col("o_orderdate").cast("date")
    periods = table(spark, d, "orders").select(F.col("o_orderkey").alias("period"), on.alias("first"), F.date_add(on, 100).alias("last"))
    period = topology.valid_period(periods, F.lit("1996-06-01").cast("date"), "first", "last", "period")
    linked = topology.with_previous(chain_points(spark, d).drop("length"), ["chain"], "point_order", "point")
    valid = linked.withColumn("period", period).filter(F.col("chain") % 7 != F.col("period") % 7)
    places = table(spark, d, "part").select(F.col("p_partkey").alias("point"), F.col("p_size").alias("x"), "p_type")
    return topology.located_topology(valid, places, "point", [("E%", "T1"), ("S%", "T3")], "p_type", "line_code").drop("p_type")
