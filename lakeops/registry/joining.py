"""Range, nearest, lookback, version and lookup joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions import coding
from lakeops.operators import joins, lookback as look, panel as panels
from lakeops.plans import service_quality as sq, ticketing
from lakeops.registry.base import PANEL, PASSAGES, money, panel, passages, query, second_of_day, table
from lakeops.session import local_table
from lakeops.sources import ingest

# Hour bands of two service slices; touching bounds belong to both bands.
BANDS = [("night", 0, 14400), ("early", 14400, 25200), ("morning", 25200, 32400), ("midday", 32400, 57600),
         ("evening", 57600, 70800), ("late", 70800, 86399)]
BRIDGE = [("weekday", "day"), ("weekday", "dark")]
SEGMENT_BANDS = [("dark", "night"), ("day", "early"), ("day", "morning"), ("day", "midday"), ("day", "evening"), ("dark", "late")]


def values(rows, name):
    return "(VALUES " + ", ".join("(" + ", ".join(repr(v) for v in r) + ")" for r in rows) + f") {name}"


HOUR_BANDS = f"""hour_bands AS (
  SELECT s.slice, b.band, b.band_from, b.band_to FROM {values([("weekday",)], "s(slice)")}
  JOIN {values(BRIDGE, "ss(slice, segment)")} ON ss.slice = s.slice
  JOIN {values(SEGMENT_BANDS, "sb(segment, band)")} ON sb.segment = ss.segment
  JOIN {values(BANDS, "b(band, band_from, band_to)")} ON b.band = sb.band)"""


def hour_bands(spark):
    slices = local_table(spark, [("weekday",)], "slice string")
    bridge = local_table(spark, BRIDGE, "slice string, segment string")
    segments = local_table(spark, SEGMENT_BANDS, "segment string, band string")
    bands = local_table(spark, BANDS, "band string, band_from int, band_to int")
    return sq.band_table(slices, segments, bridge, bands)


@query(
    "hour_band_range_join",
    f"""WITH {PASSAGES}, {HOUR_BANDS}
    SELECT slice, band, line, count(*) AS passages, CAST(sum(deviation_s) AS BIGINT) AS deviation
    FROM passages JOIN hour_bands ON hour(ts) * 3600 + minute(ts) * 60 + second(ts) BETWEEN band_from AND band_to
    GROUP BY 1, 2, 3""",
)
def hour_band_range_join(spark, d):
    rows = sq.with_band(passages(spark, d), hour_bands(spark), second_of_day("ts"))
    return rows.groupBy("slice", "band", "line").agg(
        F.count(F.lit(1)).alias("passages"), F.sum("deviation_s").alias("deviation")
    )


@query(
    "bucketed_range_join",
    """WITH s AS (SELECT c_mktsegment, min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer GROUP BY 1),
    b AS (SELECT c_mktsegment, i AS step, lo + (hi - lo) * i / 4 AS bound_from, lo + (hi - lo) * (i + 1) / 4 AS bound_to
      FROM s, (VALUES (0), (1), (2), (3)) v(i))
    SELECT c.c_mktsegment, step, count(*) AS customers FROM customer c
    LEFT JOIN b ON c.c_mktsegment = b.c_mktsegment AND c_acctbal BETWEEN bound_from AND bound_to GROUP BY 1, 2""",
)
def bucketed_range_join(spark, d):
    customers = table(spark, d, "customer")
    spread = customers.groupBy("c_mktsegment").agg(F.min("c_acctbal").alias("lo"), F.max("c_acctbal").alias("hi"))
    step = F.explode(F.sequence(F.lit(0), F.lit(3)))
    width = F.col("hi") - F.col("lo")
    bands = spread.withColumn("step", step).select(
        "c_mktsegment",
        "step",
        (F.col("lo") + width * F.col("step") / 4).alias("bound_from"),
        (F.col("lo") + width * (F.col("step") + 1) / 4).alias("bound_to"),
    )
    joined = joins.band_join(
        customers, bands, F.col("c_acctbal"), "bound_from", "bound_to", "left", ["c_mktsegment"], few=True
    )
    return joined.groupBy("c_mktsegment", "step").agg(F.count(F.lit(1)).alias("customers"))


@query(
    "bands_of_any_length",
    """WITH f AS (SELECT user_id, min(epoch_us(ts) // 1000000) AS opened FROM events GROUP BY 1),
    b AS (SELECT user_id, 'second' AS kind, opened AS band_from, opened + 1 AS band_to FROM f
      UNION ALL SELECT user_id, 'season', opened, opened + 10000000 FROM f UNION ALL SELECT user_id, 'point', opened, opened FROM f)
    SELECT e.event_type, kind, count(*) AS events FROM events e
    LEFT JOIN b ON b.user_id = e.user_id AND epoch_us(e.ts) // 1000000 BETWEEN band_from AND band_to GROUP BY 1, 2""",
)
def bands_of_any_length(spark, d):
    from lakeops.functions.clock import epoch_seconds

    events = table(spark, d, "events").withColumn("second", epoch_seconds(F.col("ts")).cast("long"))
    opened = events.groupBy("user_id").agg(F.min("second").alias("band_from"))
    spans = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(n).alias("n")) for k, n in (("second", 1), ("season", 10_000_000), ("point", 0))])
    bands = opened.withColumn("span", F.explode(spans)).select("user_id", "span.kind", "band_from", (F.col("band_from") + F.col("span.n")).alias("band_to"))
    joined = joins.band_join(events, bands, F.col("second"), "band_from", "band_to", "left", ["user_id"])
    return joined.groupBy("event_type", "kind").agg(F.count(F.lit(1)).alias("events"))


@query(
    "range_counts",
    """SELECT p.event_id, count(c.event_id) AS clicks
    FROM events p LEFT JOIN events c ON c.user_id = p.user_id AND c.event_type = 'click'
      AND c.ts BETWEEN p.ts AND p.ts + INTERVAL 12 HOUR
    WHERE p.event_type = 'purchase' GROUP BY 1""",
)
def range_counts(spark, d):
    events = table(spark, d, "events")
    spans = events.filter(F.col("event_type") == "purchase").select(
        "event_id", "user_id", "ts", (F.col("ts") + F.expr("INTERVAL 12 HOUR")).alias("until")
    )
    clicks = events.filter(F.col("event_type") == "click").select("user_id", "ts")
    return joins.count_in_ranges(spans, clicks, ["user_id"], "event_id", "ts", "until", "ts", "clicks").select(
        "event_id", "clicks"
    )


NEAREST = """WITH v AS (SELECT * FROM events WHERE event_type = 'purchase'),
    p AS (SELECT * FROM events WHERE event_type IN ('click', 'view')),
    m AS (SELECT v.event_id, p.event_id AS passage_id, p.event_type AS stop,
        row_number() OVER (PARTITION BY v.event_id ORDER BY
          CASE WHEN v.ts >= p.ts THEN epoch_us(v.ts) - epoch_us(p.ts) ELSE 10 * (epoch_us(p.ts) - epoch_us(v.ts)) END, p.ts, p.event_id) AS rn
      FROM v JOIN p ON v.user_id = p.user_id AND v.ts > p.ts - INTERVAL 20 HOUR AND v.ts < p.ts + INTERVAL 2 HOUR)"""


@query(
    "nearest_event",
    f"""{NEAREST}
    SELECT v.event_id, passage_id, stop FROM v LEFT JOIN m ON v.event_id = m.event_id AND rn = 1""",
)
def nearest_event(spark, d):
    events = table(spark, d, "events")
    subjects = events.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    targets = events.filter(F.col("event_type").isin("click", "view")).select(
        "user_id", F.col("ts").alias("at"), F.col("event_id").alias("passage_id"), F.col("event_type").alias("stop")
    )
    return joins.nearest_event(
        subjects, targets, ["user_id"], "ts", "at", ["at", "passage_id"], ["passage_id", "stop"], 2 * 3600, 20 * 3600
    ).select("event_id", "passage_id", "stop")


@query(
    "boarding_stops",
    """WITH v AS (SELECT event_id, ts, CASE WHEN user_id % 2 = 0 THEN 'north' ELSE 'south' END AS source,
        CASE WHEN user_id % 2 = 0 THEN 'N' ELSE 'S' END || CAST(user_id AS VARCHAR) AS vehicle_code FROM events WHERE event_type = 'purchase'),
    vehicles AS (SELECT DISTINCT 'N' || CAST(user_id AS VARCHAR) AS code_a, 'S' || CAST(user_id AS VARCHAR) AS code_b, user_id + 1000 AS fleet_code FROM events),
    k AS (SELECT v.*, fleet_code FROM v LEFT JOIN vehicles ON (source = 'north' AND vehicle_code = code_a) OR (source = 'south' AND vehicle_code = code_b)),
    p AS (SELECT user_id + 1000 AS fleet_code, ts AS arrived_at, event_id AS passage_id, event_type AS stop FROM events WHERE event_type <> 'purchase'),
    m AS (SELECT k.event_id, passage_id, stop, row_number() OVER (PARTITION BY k.event_id ORDER BY
          CASE WHEN ts >= arrived_at THEN epoch_us(ts) - epoch_us(arrived_at) ELSE 10 * (epoch_us(arrived_at) - epoch_us(ts)) END, arrived_at, passage_id) AS rn
      FROM k JOIN p ON k.fleet_code = p.fleet_code AND ts > arrived_at - INTERVAL 6 HOUR AND ts < arrived_at + INTERVAL 1 HOUR)
    SELECT k.event_id, k.fleet_code, passage_id, stop FROM k LEFT JOIN m ON k.event_id = m.event_id AND rn = 1""",
)
def boarding_stops(spark, d):
    events = table(spark, d, "events")
    even = F.col("user_id") % 2 == 0
    user = F.col("user_id").cast("string")
    validations = events.filter(F.col("event_type") == "purchase").select(
        "event_id",
        F.col("ts").alias("validated_at"),
        F.when(even, "north").otherwise("south").alias("source"),
        F.concat(F.when(even, "N").otherwise("S"), user).alias("vehicle_code"),
    )
    vehicles = events.select("user_id").distinct().select(
        F.concat(F.lit("N"), user).alias("code_a"),
        F.concat(F.lit("S"), user).alias("code_b"),
        (F.col("user_id") + 1000).alias("fleet_code"),
    )
    stops = events.filter(F.col("event_type") != "purchase").select(
        (F.col("user_id") + 1000).alias("fleet_code"),
        F.col("ts").alias("arrived_at"),
        F.col("event_id").alias("passage_id"),
        F.col("event_type").alias("stop"),
    )
    return ticketing.boarding_stops(
        validations, vehicles, stops, {"north": "code_a", "south": "code_b"}, ["passage_id", "stop"], 3600, 6 * 3600
    ).select("event_id", "fleet_code", "passage_id", "stop")


@query(
    "boarding_stops_listed_twice",
    """WITH v AS (SELECT event_id, ts, user_id FROM events WHERE event_type = 'purchase'),
    k AS (SELECT v.*, user_id + 1000 AS fleet_code FROM v UNION ALL SELECT v.*, user_id + 1001 FROM v WHERE user_id % 3 = 0),
    p AS (SELECT user_id + 1000 AS fleet_code, ts AS arrived_at, event_id AS passage_id FROM events WHERE event_type <> 'purchase'),
    c AS (SELECT k.event_id, k.fleet_code, passage_id, arrived_at,
        CASE WHEN ts >= arrived_at THEN epoch_us(ts) - epoch_us(arrived_at) ELSE 10 * (epoch_us(arrived_at) - epoch_us(ts)) END AS cost
      FROM k LEFT JOIN p ON k.fleet_code = p.fleet_code AND ts > arrived_at - INTERVAL 6 HOUR AND ts < arrived_at + INTERVAL 1 HOUR)
    SELECT event_id, fleet_code, passage_id FROM c
    QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY passage_id IS NULL, cost, arrived_at, fleet_code, passage_id) = 1""",
)
def boarding_stops_listed_twice(spark, d):
    """A code that is listed for two vehicles still gives a validation one passage."""
    events, user = table(spark, d, "events"), F.col("user_id").cast("string")
    validations = events.filter("event_type = 'purchase'").select("event_id", F.col("ts").alias("validated_at"), F.lit("a").alias("source"), user.alias("vehicle_code"))
    fleet = F.explode(F.when(F.col("user_id") % 3 == 0, F.array(F.lit(1000), F.lit(1001))).otherwise(F.array(F.lit(1000))))
    vehicles = events.select("user_id").distinct().select(user.alias("code"), "user_id", fleet.alias("more")).select("code", (F.col("user_id") + F.col("more")).alias("fleet_code"))
    stops = events.filter("event_type <> 'purchase'").select((F.col("user_id") + 1000).alias("fleet_code"), F.col("ts").alias("arrived_at"), F.col("event_id").alias("passage_id"))
    return ticketing.boarding_stops(validations, vehicles, stops, {"a": "code"}, ["passage_id"], 3600, 6 * 3600).select("event_id", "fleet_code", "passage_id")


@query(
    "either_key_join",
    """SELECT s_nationkey, count(*) AS pairs, CAST(sum(p_size) AS BIGINT) AS sizes
    FROM supplier JOIN part ON s_suppkey = p_partkey OR s_suppkey = p_size GROUP BY 1""",
)
def either_key_join(spark, d):
    part = table(spark, d, "part").withColumn("size_key", F.col("p_size").cast("bigint"))
    pairs = joins.either_key_join(table(spark, d, "supplier"), part, "s_suppkey", ["p_partkey", "size_key"], "inner")
    return pairs.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("pairs"), F.sum("p_size").alias("sizes"))


@query(
    "by_source_join",
    """SELECT e.event_type, n_name, count(*) AS events FROM events e LEFT JOIN nation
      ON (event_type IN ('click', 'view') AND user_id = n_nationkey) OR (event_type = 'error' AND user_id = n_regionkey)
    GROUP BY 1, 2""",
)
def by_source_join(spark, d):
    nation = table(spark, d, "nation")
    events = table(spark, d, "events").groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("n"))
    joined = joins.by_source_join(
        events, nation, "event_type", "user_id", {"click": "n_nationkey", "view": "n_nationkey", "error": "n_regionkey"}
    )
    return joined.groupBy("event_type", "n_name").agg(F.sum("n").alias("events"))


def order_days(spark, d):
    return look.daily(
        table(spark, d, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("day"), "o_totalprice"),
        "o_custkey",
        "day",
        {"n": F.lit(1), "amount": money("o_totalprice")},
    )


ORDER_DAYS = """days AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, CAST(count(*) AS BIGINT) AS n,
  sum(CAST(o_totalprice AS DECIMAL(18,2))) AS amount FROM orders GROUP BY 1, 2)"""


def _lookback_sql(lower, upper):
    return f"""WITH {ORDER_DAYS}
    SELECT a.o_custkey, a.day, CAST(coalesce(sum(b.n), 0) AS BIGINT) AS n_orders,
      CAST(coalesce(sum(b.amount), 0) AS DECIMAL(28,2)) AS total
    FROM days a LEFT JOIN days b ON a.o_custkey = b.o_custkey AND {lower} AND {upper} GROUP BY 1, 2"""


def _looked(spark, d, **options):
    out = look.lookback(order_days(spark, d), "o_custkey", "day", sums={"n_orders": "n", "total": "amount"}, **options)
    return out.select("o_custkey", "day", "n_orders", "total")


@query("lookback_3m", _lookback_sql("b.day >= CAST(a.day - INTERVAL 3 MONTH AS DATE)", "b.day < a.day"))
def lookback_3m(spark, d):
    return _looked(spark, d, months=3)


@query("lookback_1m", _lookback_sql("b.day >= CAST(a.day - INTERVAL 1 MONTH AS DATE)", "b.day < a.day"))
def lookback_1m(spark, d):
    return _looked(spark, d, months=1)


@query("lookback_10m", _lookback_sql("b.day > CAST(a.day - INTERVAL 10 MONTH AS DATE)", "b.day <= a.day"))
def lookback_10m(spark, d):
    return _looked(spark, d, months=10, include_today=True, include_edge=False)


@query("lookback_forward", _lookback_sql("b.day >= a.day", "b.day < CAST(a.day + INTERVAL 3 MONTH AS DATE)"))
def lookback_forward(spark, d):
    return _looked(spark, d, months=3, ahead=True, include_today=True, include_edge=False)


@query(
    "latest_version",
    """SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus FROM (SELECT *,
      row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
)
def latest_version(spark, d):
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    return joins.latest_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    "latest_version_ties",
    """SELECT o_custkey, o_orderkey, o_orderdate FROM orders o
    WHERE o_orderdate = (SELECT max(i.o_orderdate) FROM orders i WHERE i.o_custkey = o.o_custkey)""",
)
def latest_version_ties(spark, d):
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return joins.latest_versions(orders, ["o_custkey"], "o_orderdate")


@query(
    "scalar_latest_period",
    """SELECT o_orderstatus, count(*) AS orders FROM orders
    WHERE date_trunc('month', o_orderdate) = (SELECT max(date_trunc('month', o_orderdate)) FROM orders) GROUP BY 1""",
)
def scalar_latest_period(spark, d):
    from lakeops.plans.topology import in_latest_period

    orders = table(spark, d, "orders").withColumn("period", F.trunc(F.col("o_orderdate").cast("date"), "month"))
    return in_latest_period(orders, orders, "period").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))


@query(
    "period_valid_on_day",
    """WITH p AS (SELECT year(o_orderdate) AS period, min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders GROUP BY 1)
    SELECT period, count(*) AS orders FROM orders JOIN p ON year(o_orderdate) = period
    WHERE period = (SELECT max(period) FROM p WHERE lo <= DATE '1998-06-15' AND hi >= DATE '1998-06-15') GROUP BY 1""",
)
def period_valid_on_day(spark, d):
    from lakeops.plans.topology import valid_period

    orders = table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("day")).withColumn("period", F.year("day"))
    periods = orders.groupBy("period").agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    valid = valid_period(periods, F.lit("1998-06-15").cast("date"), "lo", "hi", "period")
    return orders.filter(F.col("period") == valid).groupBy("period").agg(F.count(F.lit(1)).alias("orders"))


@query(
    "top1_lookup",
    """SELECT c_custkey, o_orderkey AS first_urgent FROM customer LEFT JOIN (SELECT o_custkey, o_orderkey,
      row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders
      WHERE o_orderpriority = '1-URGENT') ON c_custkey = o_custkey AND rn = 1""",
)
def top1_lookup(spark, d):
    urgent = table(spark, d, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    first = joins.first_per_key(
        urgent.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"]
    )
    return table(spark, d, "customer").join(first, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", F.col("o_orderkey").alias("first_urgent")
    )


@query(
    "preagg_left_zero",
    """SELECT o_orderkey, coalesce(n, 0) AS lines FROM orders
    LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""",
)
def preagg_left_zero(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    return joins.with_count(orders, table(spark, d, "lineitem"), ["l_orderkey"], "lines").withColumnRenamed(
        "l_orderkey", "o_orderkey"
    )


@query(
    "translated_labels",
    """SELECT s_suppkey, n.n_name AS nation_label, r.r_name AS region_label FROM supplier
    LEFT JOIN nation n ON n.n_nationkey = s_nationkey LEFT JOIN region r ON r.r_regionkey = s_nationkey""",
)
def translated_labels(spark, d):
    def listed(name, key, text):
        return table(spark, d, name).select(
            F.lit(name).alias("table_name"), F.lit("en").alias("lang"), F.col(key).alias("object_id"), F.col(text).alias("text")
        )

    labels = listed("nation", "n_nationkey", "n_name").unionByName(listed("region", "r_regionkey", "r_name"))
    out = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    out = joins.translate(out, labels, "nation", "en", "s_nationkey", "nation_label")
    return joins.translate(out, labels, "region", "en", "s_nationkey", "region_label").drop("s_nationkey")


@query(
    "normalised_key_join",
    """SELECT r_name, count(*) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1""",
)
def normalised_key_join(spark, d):
    padded = table(spark, d, "nation").withColumn("key", F.rpad(F.col("n_regionkey").cast("string"), 6, " "))
    region = table(spark, d, "region").withColumn("key", F.lpad(F.col("r_regionkey").cast("string"), 6, " "))
    left = padded.withColumn("key", joins.clean_key(F.col("key"), "int"))
    right = region.withColumn("key", joins.clean_key(F.col("key"), "int"))
    return left.join(right, "key").groupBy("r_name").agg(F.count(F.lit(1)).alias("nations"))


@query(
    "anti_pending_files",
    """SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus = 'F')""",
)
def anti_pending_files(spark, d):
    files = table(spark, d, "orders").select(F.col("o_orderkey").alias("file_path"))
    loads = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("file_path"),
        F.when(F.col("l_linestatus") == "F", "success").otherwise("failed").alias("load_status"),
    )
    return ingest.pending_files(files, loads).withColumnRenamed("file_path", "o_orderkey")


@query(
    "daily_headcount",
    f"""WITH {PANEL} SELECT entity, day, count(*) OVER (PARTITION BY day) AS headcount FROM panel""",
)
def daily_headcount(spark, d):
    return joins.join_back(panel(spark, d).select("entity", "day"), ["day"], headcount=F.count(F.lit(1)))


@query(
    "calendar_enrichment",
    """WITH h AS (SELECT CAST(ts AS DATE) AS day, CASE WHEN count(*) FILTER (WHERE event_type = 'error') >= 70 THEN 1 ELSE 0 END AS bad_day FROM events GROUP BY 1)
    SELECT event_type, bad_day, count(*) AS events FROM events LEFT JOIN h ON CAST(ts AS DATE) = day GROUP BY 1, 2""",
)
def calendar_enrichment(spark, d):
    events = table(spark, d, "events").select("event_type", F.col("ts").cast("date").alias("day"))
    per_day = events.groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("n"))
    errors = F.sum(F.when(F.col("event_type") == "error", F.col("n")).otherwise(0))
    calendar = per_day.groupBy("day").agg(coding.flag(errors >= 70).alias("bad_day"))
    return per_day.join(calendar, "day", "left").groupBy("event_type", "bad_day").agg(F.sum("n").alias("events"))


@query(
    "panel_complete",
    f"""WITH {PANEL}, b AS (SELECT entity, min(day) AS lo, max(day) AS hi FROM panel GROUP BY 1),
    s AS (SELECT entity, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day FROM b)
    SELECT entity, day, coalesce(flag, 0) AS flag, CASE WHEN flag IS NULL THEN 1 ELSE 0 END AS is_missing
    FROM s LEFT JOIN panel USING (entity, day)""",
)
def panel_complete(spark, d):
    return panels.complete_panel(panel(spark, d).select("entity", "day", "flag"), "entity", "day", {"flag": 0})
