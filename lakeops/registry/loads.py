"""Landing folders, catalog tables and streams of several batches."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.operators import quality
from lakeops.registry.base import query, table
from lakeops.registry.streams import HOURLY, NOW, _plain
from lakeops.registry.upserts import ORDER_TOTALS, _order_totals, _orders
from lakeops.session import local_table, scratch_path
from lakeops.sources import buckets, files, tables
from lakeops.streaming import aggregates, sinks, sources

EARLY, LATER = "coalesce(year(day) < 1998, false)", "NOT coalesce(year(day) < 1998, false)"


def _database(spark: SparkSession) -> str:
    """A database of its own, whose managed tables live in the shared folder."""
    name = f"lakeops_{uuid.uuid4().hex}"
    tables.create_database(spark, name, scratch_path(spark, "database"))
    return name


@query(
    "dated_drop_scan",
    """SELECT 'day' AS scan, o_orderstatus, count(*) AS orders FROM orders WHERE coalesce(year(CAST(o_orderdate AS DATE)) < 1998, false) GROUP BY 2
    UNION ALL SELECT 'history', o_orderstatus, count(*) FROM orders GROUP BY 2""",
)
def dated_drop_scan(spark, d):
    """One day's landing folder, and all days."""
    root, rows = scratch_path(spark, "drops"), _orders(spark, d)
    for day, condition in ((date(1995, 1, 1), EARLY), (date(1998, 1, 1), LATER)):
        rows.filter(condition).write.parquet(files.daily_drop_path(root, "orders", day).replace("*", ""))

    def scan(label: str, day: date | None) -> DataFrame:
        read = files.read_daily_drop(spark, root, "orders", day)
        return read.groupBy(F.lit(label).alias("scan"), "o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))

    return scan("day", date(1995, 1, 1)).unionByName(scan("history", None))


@query(
    "csv_inferred_and_text",
    f"""SELECT 'double' AS price_type, t.* FROM ({ORDER_TOTALS}) t UNION ALL SELECT 'string', t.* FROM ({ORDER_TOTALS}) t""",
)
def csv_inferred_and_text(spark, d):
    path = scratch_path(spark, "orders-csv")
    tables.export_delimited(_orders(spark, d), path)

    def totals(infer: bool) -> DataFrame:
        read = files.read_delimited(spark, path, infer=infer)
        return _order_totals(read).withColumn("price_type", F.lit(dict(read.dtypes)["price"]))

    return totals(True).unionByName(totals(False))


@query("appended_table", ORDER_TOTALS)
def appended_table(spark, d):
    path, rows = scratch_path(spark, "appended"), _orders(spark, d)
    for condition in (EARLY, LATER):
        tables.append(rows.filter(condition), path)
    return _order_totals(tables.read_table(spark, path))


@query(
    "overwrite_with_new_schema",
    "SELECT o_orderkey AS id, CAST(year(o_orderdate) AS VARCHAR) AS status, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders",
)
def overwrite_with_new_schema(spark, d):
    """The replaced table had other columns, and ``status`` another type."""
    path, rows = scratch_path(spark, "replaced"), _orders(spark, d)
    tables.overwrite(rows.select("o_custkey", F.col("o_orderkey").alias("status")), path)
    tables.overwrite(rows.select(F.col("o_orderkey").alias("id"), F.year("day").cast("string").alias("status"), "price"), path)
    return tables.read_table(spark, path)


@query("external_table_again", ORDER_TOTALS)
def external_table_again(spark, d):
    """A catalog name that is moved from one folder to another."""
    database, rows = _database(spark), _orders(spark, d)
    for label, held in (("half", rows.filter(EARLY)), ("whole", rows)):
        path = scratch_path(spark, label)
        tables.overwrite(held, path)
        tables.register(spark, f"{database}.orders", path)
    return _order_totals(tables.read_table(spark, f"{database}.orders"))


@query("external_csv_table", ORDER_TOTALS)
def external_csv_table(spark, d):
    database, path = _database(spark), scratch_path(spark, "csv-table")
    tables.export_delimited(_orders(spark, d), path)
    tables.register(spark, f"{database}.orders", path, "csv", header="true", sep=";")
    return _order_totals(tables.read_table(spark, f"{database}.orders"))


@query("managed_mart", ORDER_TOTALS)
def managed_mart(spark, d):
    """A managed table, replaced by one with other columns."""
    name = f"{_database(spark)}.totals"
    tables.save_mart(_orders(spark, d).select("o_orderkey", "o_orderstatus"), name)
    tables.save_mart(_order_totals(_orders(spark, d)), name)
    return tables.read_table(spark, name)


@query(
    "catalog_statements",
    "SELECT 'kept' AS name, 'kept' AS found, 5 AS columns, count(*) AS orders FROM orders",
)
def catalog_statements(spark, d):
    """List, describe, refresh after rows were added beside the catalog, drop with files."""
    database, rows = _database(spark), _orders(spark, d)
    paths = {name: scratch_path(spark, name) for name in ("kept", "dropped")}
    for name, path in paths.items():
        tables.overwrite(rows.filter(EARLY), path)
        tables.register(spark, f"{database}.{name}", path)
    before = tables.read_table(spark, f"{database}.kept")
    tables.append(rows.filter(LATER).select(*before.columns), paths["kept"])
    tables.refresh(spark, f"{database}.kept")
    tables.drop_with_files(spark, f"{database}.dropped", paths["dropped"])
    listed = tables.list_tables(spark, database).select(F.col("tableName").alias("name"))
    described = tables.describe(spark, f"{database}.kept").filter(F.col("col_name").isin(before.columns))
    width = described.agg(F.count(F.lit(1)).cast("int").alias("columns"))
    counted = tables.read_table(spark, f"{database}.kept").agg(F.count(F.lit(1)).alias("orders"))
    parts = listed.unionByName(width, allowMissingColumns=True).unionByName(counted, allowMissingColumns=True)
    there = [n for n, path in paths.items() if tables.path_exists(spark, path)]
    return parts.agg(
        F.array_join(F.array_sort(F.collect_list("name")), ",").alias("name"), F.lit(",".join(there)).alias("found"),
        F.max("columns").alias("columns"), F.max("orders").alias("orders"),
    )


@query(
    "catalog_crawl",
    """WITH c AS (SELECT 'customer' AS t, c.* FROM (DESCRIBE customer) c UNION ALL SELECT 'orders', o.* FROM (DESCRIBE orders) o)
    SELECT t AS "table", column_name AS "column", CASE t WHEN 'orders' THEN (SELECT count(*) FROM orders) ELSE (SELECT count(*) FROM customer) END AS "rows"
    FROM c WHERE contains(lower(column_name), 'key') OR contains(lower(column_name), 'price')""",
)
def catalog_crawl(spark, d):
    """Columns of all tables of a database by a part of their names, with the rows of their tables."""
    database = _database(spark)
    for name in ("orders", "customer"):
        tables.register(spark, f"{database}.{name}", f"{d}/{name}.parquet")
    found = [quality.find_columns(spark, part, [database]) for part in ("KEY", "price")]
    counted = [
        tables.read_table(spark, f"{database}.{name}").agg(F.count(F.lit(1)).alias("rows")).withColumn("table", F.lit(name))
        for name in ("orders", "customer")
    ]
    return found[0].unionByName(found[1]).join(counted[0].unionByName(counted[1]), "table").select("table", "column", "rows")


@query("empty_relation", "SELECT o_orderstatus, count(*) AS orders, 0 AS corrections FROM orders GROUP BY 1")
def empty_relation(spark, d):
    """Orders beside a typed relation that has no rows yet."""
    none = files.empty(spark, "o_orderkey bigint, corrected boolean")
    joined = _orders(spark, d).join(none, "o_orderkey", "left")
    return joined.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"), F.count("corrected").cast("int").alias("corrections"))


@query(
    "hive_text_partition_scan",
    "SELECT strftime(CAST(o_orderdate AS DATE), '%Y') AS year, strftime(CAST(o_orderdate AS DATE), '%m') AS month, count(*) AS orders FROM orders GROUP BY 1, 2",
)
def hive_text_partition_scan(spark, d):
    """Partition values with leading zeros stay text."""
    path = scratch_path(spark, "orders-by-month")
    dated = _orders(spark, d).withColumns({"year": F.date_format("day", "yyyy"), "month": F.date_format("day", "MM")})
    tables.overwrite(dated, path, ["year", "month"])
    read = files.read_partitions(spark, path, [f"{path}/year=*/month=*"])
    return read.groupBy("year", "month").agg(F.count(F.lit(1)).alias("orders"))


@query("kept_schema_stream", ORDER_TOTALS)
def kept_schema_stream(spark, d):
    """A stream declared by a schema that was kept as JSON."""
    landed, kept, out = (scratch_path(spark, x) for x in ("landed", "schema", "out"))
    rows = _orders(spark, d)
    rows.write.parquet(landed)
    files.save_schema(spark, rows.schema, kept)
    stream = sources.file_stream(spark, landed, files.load_schema(spark, kept))
    sinks.run_available(sinks.append_files(stream, out, scratch_path(spark, "cp"), trigger=NOW))
    return _order_totals(spark.read.parquet(out))


@query(
    "stream_each_object",
    "SELECT 'orders' AS object, count(*) AS n FROM orders UNION ALL SELECT 'events', count(*) FROM events",
)
def stream_each_object(spark, d):
    """One query an object, running side by side."""
    out = {name: scratch_path(spark, name) for name in ("orders", "events")}

    def start(name: str):
        stream = sources.file_stream(spark, f"{d}/{name}.parquet", table(spark, d, name).schema)
        return sinks.append_files(stream, out[name], scratch_path(spark, "cp"), trigger=NOW)

    for started in sources.start_each(out, start).values():
        sinks.run_available(started)
    counted = [spark.read.parquet(path).agg(F.lit(name).alias("object"), F.count(F.lit(1)).alias("n")) for name, path in out.items()]
    return counted[0].unionByName(counted[1])


@query("stream_sorted_complete", HOURLY)
def stream_sorted_complete(spark, d):
    """Counts sorted in the stream, which complete mode allows, over a batch a file."""
    session = sinks.stateful_session(spark)
    landed, out = scratch_path(spark, "landed"), scratch_path(spark, "sorted")
    tables.overwrite(table(spark, d, "events").select("event_id", "ts", "event_type"), landed, files=3)
    stream = sources.file_stream(session, landed, "event_id bigint, ts timestamp_ntz, event_type string", files_per_trigger=1)
    counts = _plain(aggregates.windowed(stream, "ts", "1 hour", ["event_type"])).orderBy("window_start", "event_type")
    sinks.run_available(sinks.each_batch(counts, sinks.replace_table(out), scratch_path(spark, "cp"), "complete", trigger=NOW))
    return spark.read.parquet(out)


@query(
    "stream_progress",
    "SELECT 'watched' AS name, count(*) AS read, 4 AS batches, count(*) AS stored FROM orders",
)
def stream_progress(spark, d):
    """A running query found by its name, with what its batches read, then stopped."""
    landed, out = scratch_path(spark, "landed"), scratch_path(spark, "out")
    tables.overwrite(_orders(spark, d), landed, files=4)
    name = f"watched-{uuid.uuid4().hex}"
    stream = sources.file_stream(spark, landed, _orders(spark, d).schema, files_per_trigger=1)
    sinks.append_files(stream, out, scratch_path(spark, "cp"), name, sinks.trigger_options("processing", "0 seconds"))
    found = sinks.find_query(spark, name)
    found.processAllAvailable()
    batches = [p for p in sinks.progress_rows(found) if p["rows"]]
    found.stop()
    seen = local_table(spark, [(name.split("-")[0], sum(p["rows"] for p in batches), len(batches))], "name string, read bigint, batches int")
    both = seen.unionByName(spark.read.parquet(out).agg(F.count(F.lit(1)).alias("stored")), allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in ("name", "read", "batches", "stored")])


@query(
    "stream_file_batches",
    "SELECT 4 AS batches, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total FROM orders",
)
def stream_file_batches(spark, d):
    """One file a batch; every batch is stored with its number."""
    landed, out = scratch_path(spark, "landed"), scratch_path(spark, "batches")
    rows = _orders(spark, d)
    tables.overwrite(rows, landed, files=4)
    stream = sources.file_stream(spark, landed, rows.schema, files_per_trigger=1)

    def body(batch: DataFrame, number: int) -> None:
        tables.overwrite(batch, f"{out}/batch={number}")

    sinks.run_available(sinks.each_batch(stream, body, scratch_path(spark, "cp"), trigger=NOW))
    return spark.read.parquet(out).agg(
        F.count_distinct("batch").cast("int").alias("batches"), F.count(F.lit(1)).alias("orders"), F.sum("price").alias("total")
    )


LATE = "event_id % 10 = 0 AND ts < TIMESTAMP '2024-01-10'"


@query(
    "stream_late_rows",
    f"""WITH kept AS (SELECT * FROM events WHERE NOT ({LATE}))
    SELECT * FROM ({HOURLY.replace("FROM events", "FROM kept")}) WHERE window_end <= (SELECT max(ts) - INTERVAL 2 HOUR FROM kept)""",
)
def stream_late_rows(spark, d):
    """Rows in three deliveries, each read by a restart from the checkpoint; those of the last are behind the watermark and go."""
    session = sinks.stateful_session(spark)
    landed, out, checkpoint = (scratch_path(spark, x) for x in ("landed", "closed", "cp"))
    events = table(session, d, "events").select("event_id", "ts", "event_type")
    late = F.expr(LATE.replace("TIMESTAMP '", "TIMESTAMP_NTZ '"))
    first = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    for delivery in (events.filter(~late & first), events.filter(~late & ~first), events.filter(late)):
        tables.append(delivery, landed)
        stream = sources.file_stream(session, landed, events.schema)
        counts = aggregates.windowed(stream, "ts", "1 hour", ["event_type"], watermark="2 hours")
        sinks.run_available(sinks.append_files(_plain(counts), out, checkpoint, trigger=NOW))
    return spark.read.parquet(out)


@query(
    "stream_upsert_batches",
    """SELECT o_custkey, o_orderkey, o_orderstatus, day FROM (SELECT *, CAST(o_orderdate AS DATE) AS day,
      row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 3 DESC, o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
)
def stream_upsert_batches(spark, d):
    """Three deliveries, a restart each: a later one replaces what an earlier one stored for a customer."""
    landed, out, checkpoint = (scratch_path(spark, x) for x in ("landed", "latest", "cp"))
    rows = _orders(spark, d).select("o_custkey", "o_orderkey", "o_orderstatus", "day")
    body = sinks.upsert_buckets(out, ["o_custkey"], ["day", "o_orderkey"], 16)
    for delivery in range(3):
        tables.append(rows.filter(F.col("o_orderkey") % 3 == delivery), landed)
        stream = sources.file_stream(spark, landed, rows.schema)
        sinks.run_available(sinks.each_batch(stream, body, checkpoint, trigger=NOW))
    return buckets.read(spark, out)


@query(
    "stream_rescued",
    """SELECT CASE WHEN event_id % 7 <> 0 THEN event_id END AS event_id, CASE WHEN event_id % 7 <> 0 THEN event_type END AS event_type,
      CASE WHEN event_id % 7 = 0 THEN 'broken ' || event_id END AS rescued FROM events""",
)
def stream_rescued(spark, d):
    """Lines that are no JSON are kept as they came."""
    landed, out = scratch_path(spark, "lines"), scratch_path(spark, "rescued")
    line = F.to_json(F.struct("event_id", "event_type"))
    broken = F.concat(F.lit("broken "), F.col("event_id").cast("string"))
    table(spark, d, "events").select(F.when(F.col("event_id") % 7 == 0, broken).otherwise(line).alias("value")).write.text(landed)
    lines = sources.file_stream(spark, landed, "value string", "text")
    rescued = sources.with_rescued(lines, "event_id bigint, event_type string")
    sinks.run_available(sinks.append_files(rescued, out, scratch_path(spark, "cp"), trigger=NOW))
    return spark.read.parquet(out)


@query(
    "stream_growing",
    """SELECT CASE WHEN event_id % 3 = 2 AND event_id % 5 < 2 THEN NULL ELSE event_id END AS event_id,
      CASE WHEN event_id % 3 = 2 AND event_id % 5 = 0 THEN NULL ELSE event_type END AS event_type,
      CASE WHEN event_id % 3 = 1 THEN user_id END AS user,
      CASE WHEN event_id % 3 = 2 AND event_id % 5 = 0 THEN 'broken ' || event_id WHEN event_id % 3 = 2 AND event_id % 5 = 1 THEN '{"event_id":"no ' || event_id || '"}' END AS rescued FROM events""",
)
def stream_growing(spark, d):
    """Three deliveries: as declared, with a new field, and with values of a wrong type and broken lines."""
    landed, out, checkpoint = (scratch_path(spark, x) for x in ("lines", "growing", "cp"))
    events, first = table(spark, d, "events"), "event_id bigint, event_type string"
    wrong = F.to_json(F.struct(F.concat(F.lit("no "), F.col("event_id")).alias("event_id"), "event_type"))
    plain, wider = F.to_json(F.struct("event_id", "event_type")), F.to_json(F.struct("event_id", "event_type", F.col("user_id").alias("user")))
    broken = F.concat(F.lit("broken "), F.col("event_id"))
    fifth = F.col("event_id") % 5
    for delivery, line in enumerate((plain, wider, F.when(fifth == 0, broken).when(fifth == 1, wrong).otherwise(plain))):
        events.filter(F.col("event_id") % 3 == delivery).select(line.alias("value")).write.mode("append").text(landed)
        lines = sources.file_stream(spark, landed, "value string", "text")
        sinks.run_available(sinks.each_batch(lines, sources.growing_table(out, first), checkpoint, trigger=NOW))
    return sources.read_growing(spark, out, first)


@query(
    "schema_check",
    """SELECT 'l_orderkey' AS "column", true AS ok, count(*) AS lines FROM lineitem UNION ALL SELECT 'l_comment_missing', false, count(*) FROM lineitem
    UNION ALL SELECT 'l_quantity', false, count(*) FROM lineitem""",
)
def schema_check(spark, d):
    """Expected types against those of the table: one as expected, one missing, one of another type."""
    lines = table(spark, d, "lineitem")
    checked = quality.expect_schema(lines, {"l_orderkey": "bigint", "l_comment_missing": "string", "l_quantity": "date"})
    counted = lines.select(F.explode(F.array(*[F.lit(c) for c in ("l_orderkey", "l_comment_missing", "l_quantity")])).alias("column"))
    return checked.join(counted.groupBy("column").agg(F.count(F.lit(1)).alias("lines")), "column").select("column", F.coalesce("ok", F.lit(False)).alias("ok"), "lines")
