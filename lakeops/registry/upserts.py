"""Keyed upserts, content hashes, scans and load bookkeeping."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions.hashing import row_hash, with_identity
from lakeops.operators import quality, upsert
from lakeops.registry.base import money, query, table
from lakeops.session import scratch_path
from lakeops.sources import buckets, files, ingest, tables

KEYS = upsert.key_columns("o_orderkey | o_custkey")


def _orders(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", money("o_totalprice").alias("price"), F.col("o_orderdate").cast("date").alias("day")
    )


def _target(spark, d):
    return _orders(spark, d).filter(F.col("day") < F.lit("2000-01-01").cast("date"))


def _batch(spark, d):
    """A year of overlap with the target, restated, and everything after it."""
    late = _orders(spark, d).filter(F.col("day") >= F.lit("1999-01-01").cast("date"))
    return late.withColumn("price", (F.col("price") + 100).cast("decimal(18,2)"))


ORDERS = """o AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS price, CAST(o_orderdate AS DATE) AS day FROM orders),
t AS (SELECT * FROM o WHERE day < DATE '2000-01-01'),
u AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(price + 100 AS DECIMAL(18,2)) AS price, day FROM o WHERE day >= DATE '1999-01-01')"""
UPSERTED = f"""WITH {ORDERS} SELECT * FROM u UNION ALL SELECT * FROM t
  WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.o_orderkey = t.o_orderkey AND u.o_custkey = t.o_custkey)"""


@query("upsert_all", UPSERTED)
def upsert_all(spark, d):
    return upsert.upsert_all(_target(spark, d), _batch(spark, d), KEYS)


@query(
    "upsert_operations",
    f"""WITH {ORDERS}, w AS (SELECT coalesce(t.day, u.day) AS day, CASE WHEN u.o_orderkey IS NULL THEN 'kept' WHEN t.o_orderkey IS NULL THEN 'inserted' ELSE 'updated' END AS op
      FROM t FULL JOIN u ON t.o_orderkey = u.o_orderkey AND t.o_custkey = u.o_custkey)
    SELECT year(day) AS year, op, count(*) AS orders FROM w GROUP BY 1, 2""",
)
def upsert_operations(spark, d):
    out = upsert.upsert_all(_target(spark, d), _batch(spark, d), KEYS, with_op=True)
    return out.groupBy(F.year("day").alias("year"), F.col("_op").alias("op")).agg(F.count(F.lit(1)).alias("orders"))


@query("upsert_partitioned", UPSERTED.replace("SELECT * FROM u", "SELECT *, year(day) AS year FROM u").replace("SELECT * FROM t", "SELECT *, year(day) AS year FROM t"))
def upsert_partitioned(spark, d):
    path = scratch_path(spark, "orders")
    for rows in (_target(spark, d), _batch(spark, d)):
        tables.create_or_upsert(spark, path, rows.withColumn("year", F.year("day")), KEYS, ["year"])
    return spark.read.parquet(path)


# Partition values that look like numbers, need escaping, are empty or null.
PLACES = """CASE WHEN o_orderstatus = 'F' THEN '01' WHEN o_orderstatus = 'O' THEN 'a:b' WHEN o_orderkey % 2 = 0 THEN '' END"""


def _typed(spark, path, rows):
    return tables.read_partitioned(spark, path, rows.schema, ["place"])


@query(
    "upsert_text_partition",
    UPSERTED.replace("SELECT * FROM u", f"SELECT *, nullif({PLACES}, '') AS place FROM u").replace("SELECT * FROM t", f"SELECT *, nullif({PLACES}, '') AS place FROM t"),
)
def upsert_text_partition(spark, d):
    path = scratch_path(spark, "orders-by-place")
    for rows in (_target(spark, d), _batch(spark, d)):
        rows = rows.withColumn("place", F.expr(PLACES))
        tables.create_or_upsert(spark, path, rows, KEYS, ["place"])
    return _typed(spark, path, rows)


@query(
    "upsert_moves_partition",
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN '07' WHEN o_orderkey % 2 = 0 THEN 'a:b' ELSE '7' END AS place FROM orders""",
)
def upsert_moves_partition(spark, d):
    """Orders of one state leave their partitions, one of which is emptied."""
    path = scratch_path(spark, "orders-moved")
    orders = _orders(spark, d).select("o_orderkey", "o_custkey", "o_orderstatus")
    even = F.when(F.col("o_orderkey") % 2 == 0, "a:b").otherwise("7")
    first = orders.withColumn("place", F.when(F.col("o_orderstatus") == "F", "x=y z").otherwise(even)).drop("o_orderstatus")
    moved = orders.filter("o_orderstatus = 'F'").withColumn("place", F.lit("07")).drop("o_orderstatus")
    for rows in (first, moved):
        tables.create_or_upsert(spark, path, rows, KEYS, ["place"])
    return _typed(spark, path, rows)


@query(
    "upsert_evolve",
    f"""WITH {ORDERS} SELECT coalesce(u.o_orderkey, t.o_orderkey) AS o_orderkey, t.o_custkey, coalesce(u.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
      u.price FROM t FULL JOIN u ON t.o_orderkey = u.o_orderkey""",
)
def upsert_evolve(spark, d):
    target = _target(spark, d).select("o_orderkey", "o_custkey", "o_orderstatus")
    updates = _batch(spark, d).select("o_orderkey", "o_orderstatus", "price")
    return upsert.upsert_evolving(target, updates, ["o_orderkey"])


@query(
    "upsert_add",
    f"""WITH {ORDERS}, a AS (SELECT o_custkey, count(*) AS orders, sum(price) AS total FROM t GROUP BY 1), b AS (SELECT o_custkey, count(*) AS orders, sum(price) AS total FROM u GROUP BY 1)
    SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, coalesce(a.orders, 0) + coalesce(b.orders, 0) AS orders,
      CAST(coalesce(a.total, 0) + coalesce(b.total, 0) AS DECIMAL(28,2)) AS total FROM a FULL JOIN b ON a.o_custkey = b.o_custkey""",
)
def upsert_add(spark, d):
    def totals(rows):
        return rows.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), F.sum("price").alias("total"))

    return upsert.upsert_adding(totals(_target(spark, d)), totals(_batch(spark, d)), ["o_custkey"], ["orders", "total"])


@query(
    "replay_latest_wins",
    """SELECT o_custkey, o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day FROM (SELECT *,
      row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
)
def replay_latest_wins(spark, d):
    return upsert.replay_latest(_orders(spark, d).drop("price"), ["o_custkey", "o_orderstatus"], ["day", "o_orderkey"])


def _events(spark, d):
    return table(spark, d, "events").select("event_id", "event_type", "user_id", money("value").alias("value"), F.col("ts").cast("date").alias("day"))


HASHED = """h AS (SELECT event_id, event_type, user_id, CAST(value AS DECIMAL(18,2)) AS value, CAST(ts AS DATE) AS day,
  sha256(concat_ws('||', CAST(ts AS DATE), event_id, event_type, user_id, CAST(value AS DECIMAL(18,2)))) AS row_key FROM events)"""


@query("row_hash", f"WITH {HASHED} SELECT event_id, row_key, row_key[1:1] AS row_bucket, 'load-1' AS first_load_id, 'load-1' AS last_load_id FROM h")
def row_hash_query(spark, d):
    return with_identity(_events(spark, d), "load-1").select("event_id", "row_key", "row_bucket", "first_load_id", "last_load_id")


def _hash_merge(spark, d):
    events = _events(spark, d)
    old = with_identity(events.filter(F.col("day") < F.lit("2024-01-20").cast("date")), "load-1")
    new = with_identity(events.filter(F.col("day") >= F.lit("2024-01-10").cast("date")), "load-2")
    return upsert.merge_by_hash(old, new, with_op=True)


HASH_MERGE = f"""{HASHED}, m AS (SELECT *, CASE WHEN day < DATE '2024-01-20' THEN 'load-1' ELSE 'load-2' END AS first_load_id,
  CASE WHEN day >= DATE '2024-01-10' THEN 'load-2' ELSE 'load-1' END AS last_load_id,
  CASE WHEN day >= DATE '2024-01-20' THEN 'inserted' WHEN day >= DATE '2024-01-10' THEN 'updated' ELSE 'kept' END AS op FROM h)"""


@query("hash_merge", f"WITH {HASH_MERGE} SELECT event_id, row_key, first_load_id, last_load_id FROM m")
def hash_merge(spark, d):
    return _hash_merge(spark, d).select("event_id", "row_key", "first_load_id", "last_load_id")


@query(
    "merge_metrics",
    f"""WITH {HASH_MERGE} SELECT count(*) FILTER (WHERE op = 'kept') AS rows_kept, count(*) FILTER (WHERE op = 'updated') AS rows_updated,
      count(*) FILTER (WHERE op = 'inserted') AS rows_inserted FROM m""",
)
def merge_metrics(spark, d):
    return upsert.merge_metrics(_hash_merge(spark, d))


@query(
    "audited_load",
    f"""WITH {HASH_MERGE} SELECT event_id, event_type, user_id, value, day, row_key, row_key[1:1] AS row_bucket, first_load_id, last_load_id FROM m""",
)
def audited_load(spark, d):
    path = scratch_path(spark, "audited")
    events = _events(spark, d).withColumnsRenamed({"event_id": "Event ID", "event_type": "Event-Type"})
    ingest.load(spark, events.filter(F.col("day") < F.lit("2024-01-20").cast("date")), path, "load-1", "reload", buckets=16)
    ingest.load(spark, events.filter(F.col("day") >= F.lit("2024-01-10").cast("date")), path, "load-2", "append", buckets=16)
    return buckets.read(spark, path)


@query(
    "upsert_buckets",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 AND o_orderkey <= 2000 THEN 'NEW' ELSE o_orderstatus END AS status FROM orders
    UNION ALL SELECT -o_orderkey, 'NEW' FROM orders WHERE o_orderkey % 5 = 0 AND o_orderkey BETWEEN 1 AND 40
    UNION ALL SELECT 0, 'first version: ' || count(*) FROM orders""",
)
def upsert_buckets(spark, d):
    """A small batch of updates and inserts; the version before it can still be read."""
    path = scratch_path(spark, "bucketed")
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    buckets.upsert(spark, path, orders, ["o_orderkey"], 16)
    hit = orders.filter("o_orderkey % 5 = 0 AND o_orderkey <= 2000").withColumn("status", F.lit("NEW"))
    added = hit.filter("o_orderkey BETWEEN 1 AND 40").withColumn("o_orderkey", -F.col("o_orderkey"))
    buckets.upsert(spark, path, hit.unionAll(added), ["o_orderkey"])
    before = buckets.read(spark, path, 0).agg(F.lit(0).cast("long").alias("o_orderkey"), F.concat(F.lit("first version: "), F.count(F.lit(1))).alias("status"))
    return buckets.read(spark, path).unionByName(before)


@query(
    "null_safe_hash",
    """SELECT doc_id, sha256(concat_ws('||', CAST(doc_id AS VARCHAR), coalesce(CAST(quality AS VARCHAR), '~'), coalesce(CAST(toxic AS VARCHAR), '~'))) AS row_key
    FROM documents LEFT JOIN labels USING (doc_id)""",
)
def null_safe_hash(spark, d):
    joined = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    return joined.select("doc_id", row_hash(joined, null_token="~").alias("row_key"))


@query(
    "column_profile",
    """SELECT 0 AS position, 'o_orderkey' AS "column", 'bigint' AS type, 'bigint' AS warehouse_type, count(o_orderkey) AS filled FROM orders
    UNION ALL SELECT 1, 'o_custkey', 'bigint', 'bigint', count(o_custkey) FROM orders
    UNION ALL SELECT 2, 'o_orderstatus', 'string', 'nvarchar(4000)', count(o_orderstatus) FROM orders
    UNION ALL SELECT 3, 'o_totalprice', 'double', 'float', count(o_totalprice) FROM orders
    UNION ALL SELECT 4, 'o_orderdate', 'timestamp_ntz', 'datetime2', count(o_orderdate) FROM orders
    UNION ALL SELECT 5, 'o_orderpriority', 'string', 'nvarchar(4000)', count(o_orderpriority) FROM orders""",
)
def column_profile(spark, d):
    return quality.column_profile(table(spark, d, "orders"))


@query("file_provenance", "SELECT 'lineitem.parquet' AS file_name, count(*) AS rows, max(l_shipdate) AS last_shipped FROM lineitem")
def file_provenance(spark, d):
    rows = files.with_provenance(table(spark, d, "lineitem").select("l_shipdate", "_metadata"))
    return rows.groupBy("file_name").agg(F.count(F.lit(1)).alias("rows"), F.max("l_shipdate").alias("last_shipped"))


@query("file_stats", "SELECT 1 AS files, count(*) AS rows, true AS sized FROM lineitem")
def file_stats(spark, d):
    """``bytes`` differs from writer to writer, so it is only checked to be there."""
    return quality.file_stats(table(spark, d, "lineitem")).select("files", "rows", (F.col("bytes") > 0).alias("sized"))


@query("rows_per_partition", "SELECT count(*) AS rows, true AS one_row_each FROM lineitem")
def rows_per_partition(spark, d):
    """How rows are spread depends on the cluster; their sum does not."""
    spread = quality.rows_per_partition(table(spark, d, "lineitem"))
    return spread.agg(F.sum("rows").alias("rows"), (F.count(F.lit(1)) == F.count_distinct("partition")).alias("one_row_each"))


@query(
    "dataset_ids",
    """WITH roots AS (SELECT DISTINCT array_to_string(string_split(url, '/')[1:n], '/') AS root FROM pages, (VALUES (3), (4)) v(n) WHERE len(string_split(url, '/')) > n)
    SELECT page_id, url, (SELECT max_by(root, length(root)) FROM roots WHERE url = root OR starts_with(url, root || '/')) AS dataset_id FROM pages""",
)
def dataset_ids(spark, d):
    pages = table(spark, d, "pages").select("page_id", "url")
    parts = F.split("url", "/")
    roots = pages.select(F.explode(F.array(F.lit(3), F.lit(4))).alias("n"), parts.alias("p")).filter(F.size("p") > F.col("n"))
    roots = roots.select(F.array_join(F.slice("p", F.lit(1), F.col("n")), "/").alias("root")).distinct()
    roots = roots.withColumn("dataset_id", F.col("root"))
    return ingest.with_dataset(pages, roots, "url", "__never__")


@query(
    "file_times",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) ELSE ts + INTERVAL 1 HOUR END AS file_ts FROM events""",
)
def file_times(spark, d):
    stamp = F.when(F.col("event_type") != "error", F.date_format("ts", "yyyyMMdd_HHmmss")).otherwise("none")
    name = F.concat(F.lit("/landing/log_"), stamp, F.lit(".parquet"))
    modified = (F.col("ts") + F.expr("INTERVAL 1 HOUR")).cast("timestamp")
    return table(spark, d, "events").select(
        "event_id", ingest.file_time(name, modified).cast("timestamp_ntz").alias("file_ts")
    )


@query(
    "job_log",
    """SELECT user_id AS load_id, CASE WHEN max(ts) >= TIMESTAMP '2024-01-29' THEN 'success' ELSE 'started' END AS load_status, min(ts) AS started_at,
      CASE WHEN max(ts) >= TIMESTAMP '2024-01-29' THEN max(ts) END AS finished_at FROM events GROUP BY 1""",
)
def job_log(spark, d):
    loads = table(spark, d, "events").groupBy(F.col("user_id").alias("load_id")).agg(
        F.min("ts").alias("started_at"), F.max("ts").alias("finished_at")
    )
    log = ingest.write_log(None, loads.select("load_id", F.lit("started").alias("load_status"), "started_at"))
    done = loads.filter(F.col("finished_at") >= F.lit("2024-01-29").cast("timestamp_ntz"))
    return ingest.write_log(log, done.select("load_id", F.lit("success").alias("load_status"), "finished_at"))


ORDER_TOTALS = "SELECT o_orderstatus, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total FROM orders GROUP BY 1"


def _order_totals(rows):
    return rows.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"), F.sum(F.col("price").cast("decimal(18,2)")).alias("total"))


@query("csv_round_trip", ORDER_TOTALS)
def csv_round_trip(spark, d):
    path = scratch_path(spark, "orders-csv") + ".csv"
    tables.export_delimited(_orders(spark, d), path, ";", single_file=False)
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, price decimal(18,2), day date"
    return _order_totals(files.read_delimited(spark, path, schema, encoding="UTF-8"))


@query("json_round_trip", ORDER_TOTALS)
def json_round_trip(spark, d):
    path = scratch_path(spark, "orders-json") + ".jsonl"
    _orders(spark, d).write.json(path)
    return _order_totals(files.read_any(spark, path, "o_orderstatus string, price decimal(18,2)"))


@query(
    "hive_partition_scan",
    "SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, count(*) AS orders FROM orders GROUP BY 1",
)
def hive_partition_scan(spark, d):
    path = scratch_path(spark, "orders-by-year")
    tables.overwrite(_orders(spark, d).withColumn("year", F.year("day")), path, ["year"])
    return files.read_partitions(spark, path, [f"{path}/year=*"]).groupBy("year").agg(F.count(F.lit(1)).alias("orders"))


@query("compacted_table", ORDER_TOTALS)
def compacted_table(spark, d):
    small, large = scratch_path(spark, "small-files"), scratch_path(spark, "compacted")
    tables.overwrite(_orders(spark, d), small, files=32)
    tables.compact(spark, small, large, files=4, cluster_by=["o_orderkey"])
    return _order_totals(spark.read.parquet(large))


@query(
    "packed_files",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS keys, 1 AS files FROM orders WHERE o_orderkey % 50 <> 0 GROUP BY 1""",
)
def packed_files(spark, d):
    """Many small files a year, packed into one each."""
    path = scratch_path(spark, "small-files")
    rows = table(spark, d, "orders").filter("o_orderkey % 50 <> 0").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    rows.repartition(6).write.partitionBy("year").parquet(path)
    tables.compact_small(spark, path, target=2**30, partition_by=["year"])
    packed = spark.read.parquet(path)
    return packed.groupBy("year").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("keys"), F.count_distinct("_metadata.file_path").cast("int").alias("files")
    )


@query(
    "daily_drop_scan",
    """SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY 1""",
)
def daily_drop_scan(spark, d):
    root = scratch_path(spark, "landing")
    early = F.coalesce(F.year("day") < 1998, F.lit(False))
    for name, condition in (("1995/01/01", early), ("1998/01/01", ~early)):
        _orders(spark, d).filter(condition).write.mode("overwrite").parquet(f"{root}/orders/{name}/orders.parquet")
    rows = files.read_history(spark, f"{root}/orders")
    return rows.groupBy("day").agg(F.count(F.lit(1)).alias("orders"))


@query("lineage_cut", ORDER_TOTALS)
def lineage_cut(spark, d):
    from lakeops.session import cut_lineage

    return _order_totals(cut_lineage(_orders(spark, d)))
