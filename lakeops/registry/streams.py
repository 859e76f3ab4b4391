"""Event-time windows and streaming jobs, compared with their batch meaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.registry.base import money, query, table
from lakeops.session import scratch_path
from lakeops.sources import buckets, bus
from lakeops.streaming import aggregates, sinks, sources

NOW = sinks.trigger_options("available")


def _stream(spark, d, name="events", **options):
    return sources.file_stream(spark, f"{d}/{name}.parquet", table(spark, d, name).schema, **options)


def _plain(df):
    """Window bounds back to zone-less timestamps."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in df.columns if c.endswith(("_start", "_end"))})


HOURLY = """SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, count(*) AS n
  FROM events GROUP BY 1, 2, 3"""


@query("tumbling_counts", HOURLY)
def tumbling_counts(spark, d):
    return _plain(aggregates.windowed(table(spark, d, "events"), "ts", "1 hour", ["event_type"]))


@query(
    "sliding_counts",
    """WITH s AS (SELECT event_type, unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS window_start FROM events)
    SELECT event_type, window_start, window_start + INTERVAL 1 HOUR AS window_end, count(*) AS n FROM s GROUP BY 1, 2""",
)
def sliding_counts(spark, d):
    return _plain(aggregates.windowed(table(spark, d, "events"), "ts", "1 hour", ["event_type"], slide="30 minutes"))


@query("stream_complete_equals_batch", HOURLY)
def stream_complete_equals_batch(spark, d):
    session = sinks.stateful_session(spark)
    out = scratch_path(spark, "hourly")
    counts = _plain(aggregates.windowed(_stream(session, d), "ts", "1 hour", ["event_type"]))
    sinks.run_available(
        sinks.each_batch(counts, sinks.replace_table(out), scratch_path(spark, "cp"), "complete", trigger=NOW)
    )
    return spark.read.parquet(out)


@query(
    "stream_append_closed_windows",
    f"""SELECT * FROM ({HOURLY}) WHERE window_end <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events)""",
)
def stream_append_closed_windows(spark, d):
    session = sinks.stateful_session(spark)
    out = scratch_path(spark, "closed")
    counts = aggregates.windowed(_stream(session, d), "ts", "1 hour", ["event_type"], watermark="2 hours")
    sinks.run_available(sinks.append_files(_plain(counts), out, scratch_path(spark, "cp"), trigger=NOW))
    return spark.read.parquet(out)


@query(
    "stream_sliding_update",
    """WITH s AS (SELECT unnest([time_bucket(INTERVAL 1 HOUR, ts), time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL 1 HOUR]) AS window_start FROM events)
    SELECT window_start, window_start + INTERVAL 2 HOUR AS window_end, count(*) AS n FROM s GROUP BY 1""",
)
def stream_sliding_update(spark, d):
    session = sinks.stateful_session(spark)
    out = scratch_path(spark, "sliding")
    counts = _plain(aggregates.windowed(_stream(session, d), "ts", "2 hours", slide="1 hour", watermark="2 hours"))
    body = sinks.upsert_table(out, ["window_start"], ["n"])
    sinks.run_available(sinks.each_batch(counts, body, scratch_path(spark, "cp"), "update", trigger=NOW))
    return spark.read.parquet(out)


@query(
    "stream_upsert",
    """SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
)
def stream_upsert(spark, d):
    out = scratch_path(spark, "latest-orders")
    rows = _stream(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    body = sinks.upsert_buckets(out, ["o_custkey"], ["o_orderdate", "o_orderkey"], 16)
    sinks.run_available(sinks.each_batch(rows, body, scratch_path(spark, "cp"), trigger=NOW))
    return buckets.read(spark, out)


@query(
    "stream_json_flatten",
    """SELECT event_id, event_type AS kind, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events""",
)
def stream_json_flatten(spark, d):
    out = scratch_path(spark, "flat")
    body = _stream(spark, d).select("event_id", F.col("event_type").alias("kind"), F.col("props").cast("binary").alias("body"))
    flat = bus.flatten_body(body, "k int")
    sinks.run_available(sinks.append_files(flat, out, scratch_path(spark, "cp"), trigger=NOW))
    return spark.read.parquet(out)


@query(
    "stream_incremental_ingest",
    "SELECT l_returnflag, count(*) AS lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total FROM lineitem GROUP BY 1",
)
def stream_incremental_ingest(spark, d):
    out = scratch_path(spark, "lines")
    rows = _stream(spark, d, "lineitem").select("l_orderkey", "l_returnflag", money("l_extendedprice").alias("price"))
    sinks.run_available(sinks.append_files(rows, out, scratch_path(spark, "cp"), trigger=NOW))
    return spark.read.parquet(out).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("lines"), F.sum("price").alias("total"))


@query(
    "sessions",
    """WITH e AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 3 HOUR THEN 1 ELSE 0 END AS start FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    r AS (SELECT *, sum(start) OVER (PARTITION BY user_id ORDER BY ts) AS run FROM e)
    SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 3 HOUR AS session_end, count(*) AS n FROM r GROUP BY user_id, run""",
)
def sessions(spark, d):
    """Sessions as runs of a chunked timeline, so a busy user is spread over many tasks."""
    from lakeops.functions.clock import epoch_micros
    from lakeops.operators import timeline as tl

    events = table(spark, d, "events")
    line = tl.Timeline(("user_id",), ("ts", "event_id"), tl.ROWS)
    gap = 3 * 3600 * 1_000_000
    runs = tl.with_runs(
        events, line, "run", ["ts"],
        lambda before, here: epoch_micros(here("ts")) - epoch_micros(before("ts")) >= gap,
    )
    return runs.groupBy("user_id", "run").agg(
        F.min("ts").alias("session_start"),
        (F.max("ts") + F.expr("INTERVAL 3 HOUR")).alias("session_end"),
        F.count(F.lit(1)).alias("n"),
    ).drop("run")
