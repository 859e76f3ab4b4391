"""Aggregation, quantiles, text, reshaping and calendars."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions import coding
from lakeops.functions.geo import _parameters, conic_zone_cc, to_lonlat
from lakeops.operators import panel as panels, quality, reshape, summaries
from lakeops.plans import calendar as cal
from lakeops.registry.base import money, query, table
from lakeops.session import cut_lineage


@query(
    "grouped_statistics",
    """SELECT l_returnflag, l_linestatus, count(*) AS lines, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS quantity,
      min(l_extendedprice) AS lowest, max(l_extendedprice) AS highest,
      round(CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(*), 9) AS mean_quantity
    FROM lineitem GROUP BY 1, 2""",
)
def grouped_statistics(spark, d):
    total = F.sum(money("l_quantity"))
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("lines"),
        total.alias("quantity"),
        F.min("l_extendedprice").alias("lowest"),
        F.max("l_extendedprice").alias("highest"),
        F.round(total.cast("double") / F.count(F.lit(1)), 9).alias("mean_quantity"),
    )


@query(
    "conditional_shares",
    """WITH c AS (SELECT user_id, count(*) FILTER (WHERE hour(ts) < 7) AS early, count(*) FILTER (WHERE hour(ts) BETWEEN 7 AND 17) AS daytime,
      count(*) FILTER (WHERE hour(ts) > 17) AS late, count(*) FILTER (WHERE value < 20) AS small, count(*) FILTER (WHERE value >= 400) AS big FROM events GROUP BY 1)
    SELECT user_id, round(CAST(early AS DOUBLE) / (early + daytime + late), 9) AS part_early, round(CAST(daytime AS DOUBLE) / (early + daytime + late), 9) AS part_daytime,
      round(CAST(late AS DOUBLE) / (early + daytime + late), 9) AS part_late,
      CASE WHEN small + big > 0 THEN round(CAST(small AS DOUBLE) / (small + big), 9) END AS part_small,
      CASE WHEN small + big > 0 THEN round(CAST(big AS DOUBLE) / (small + big), 9) END AS part_big FROM c""",
)
def conditional_shares(spark, d):
    hour, value = F.hour("ts"), F.col("value")
    conditions = {
        "early": hour < 7, "daytime": hour.between(7, 17), "late": hour > 17, "small": value < 20, "big": value >= 400,
    }
    counts = table(spark, d, "events").groupBy("user_id").agg(*summaries.conditional_counts(conditions))
    shares = summaries.shares_within(counts, {"time": ["early", "daytime", "late"], "size": ["small", "big"]})
    return shares.select("user_id", *[F.round(f"part_{c}", 9).alias(f"part_{c}") for c in conditions])


@query(
    "group_percentiles",
    """SELECT l_returnflag, quantile_disc(l_extendedprice, 0.3) AS low, quantile_disc(l_extendedprice, 0.5) AS median,
      quantile_disc(l_extendedprice, 0.9) AS high FROM lineitem GROUP BY 1""",
)
def group_percentiles(spark, d):
    return summaries.exact_quantiles(
        table(spark, d, "lineitem"), "l_extendedprice", {"low": "0.3", "median": "0.5", "high": "0.9"}, ["l_returnflag"]
    )


@query(
    "global_quantiles",
    """SELECT quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3, quantile_disc(value, 0.95) AS q95 FROM events""",
)
def global_quantiles(spark, d):
    return summaries.exact_quantiles(table(spark, d, "events"), "value", {"q1": "0.25", "q3": "0.75", "q95": "0.95"})


@query("approximate_percentiles")
def approximate_percentiles(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        *summaries.approximate_quantiles("l_extendedprice", {"low": 0.3, "median": 0.5, "high": 0.9})
    )


@query(
    "approximate_percentile_ranks",
    """SELECT l_returnflag, count(*) AS n, true AS low, true AS median, true AS high FROM lineitem GROUP BY 1""",
)
def approximate_percentile_ranks(spark, d):
    """Whether the rank of each approximate percentile is within the sketch's bound of the rank asked for."""
    wanted = {"low": 0.3, "median": 0.5, "high": 0.9}
    lines = table(spark, d, "lineitem").select("l_returnflag", "l_extendedprice").filter("l_returnflag IS NOT NULL")
    # One entry a group, as a scalar subquery: a join would bring the lines of a group into one task.
    entries = F.collect_list(F.struct("l_returnflag", F.struct(*wanted)))
    found = approximate_percentiles(spark, d).filter("l_returnflag IS NOT NULL").agg(F.map_from_entries(entries)).scalar()
    rated = lines.withColumn("found", found[F.col("l_returnflag")]).select("l_returnflag", "l_extendedprice", "found.*")
    ranks = rated.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col("l_extendedprice") < F.col(name)).alias(f"{name}_below") for name in wanted],
        *[F.count_if(F.col("l_extendedprice") <= F.col(name)).alias(f"{name}_upto") for name in wanted],
    )

    def within(name: str, p: float):
        slack = F.col("n") * 0.001 + 1
        return (F.col(f"{name}_below") <= F.col("n") * p + slack) & (F.col(f"{name}_upto") >= F.col("n") * p - slack)

    return ranks.select("l_returnflag", "n", *[within(name, p).alias(name) for name, p in wanted.items()])


@query(
    "quantile_flag",
    """SELECT event_id, CASE WHEN value >= (SELECT quantile_disc(value, 0.9) FROM events) THEN 1 ELSE 0 END AS is_high FROM events""",
)
def quantile_flag(spark, d):
    out = summaries.flag_above_quantile(table(spark, d, "events"), "value", "0.9", "is_high")
    return out.select("event_id", "is_high")


@query(
    "having_duplicates",
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def having_duplicates(spark, d):
    return quality.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "duplicate_audit_top",
    """SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1 ORDER BY n DESC, l_partkey""",
)
def duplicate_audit_top(spark, d):
    repeated = quality.duplicate_keys(table(spark, d, "lineitem"), ["l_partkey"])
    return repeated.orderBy(F.col("n").desc(), "l_partkey")


@query(
    "exact_duplicates",
    """SELECT (SELECT count(*) FROM documents) AS rows_before, (SELECT count(*) FROM (SELECT DISTINCT text, lang, source FROM documents)) AS rows_after""",
)
def exact_duplicates(spark, d):
    return quality.duplicate_counts(table(spark, d, "documents").select("text", "lang", "source"))


@query(
    "key_subset_dedupe",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM lineitem) WHERE rn = 1""",
)
def key_subset_dedupe(spark, d):
    from lakeops.operators.joins import latest_per_key

    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return latest_per_key(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"]).drop("l_shipdate")


@query(
    "distinct_rows",
    """SELECT DISTINCT o_orderstatus, o_orderpriority, year(o_orderdate) AS year FROM orders""",
)
def distinct_rows(spark, d):
    return table(spark, d, "orders").select("o_orderstatus", "o_orderpriority", F.year("o_orderdate").alias("year")).distinct()


@query(
    "distinct_counts",
    """SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers, count(DISTINCT CAST(o_orderdate AS DATE)) AS days FROM orders GROUP BY 1""",
)
def distinct_counts(spark, d):
    orders = table(spark, d, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    return summaries.distinct_counts(orders, ["o_orderpriority"], customers="o_custkey", days="day")


@query(
    "group_then_window",
    """SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_type DESC) AS rn FROM (SELECT p_brand, p_type FROM part GROUP BY 1, 2)""",
)
def group_then_window(spark, d):
    from pyspark.sql import Window

    pairs = table(spark, d, "part").select("p_brand", "p_type").distinct()
    return pairs.withColumn("rn", F.row_number().over(Window.partitionBy("p_brand").orderBy(F.col("p_type").desc())))


@query(
    "ordered_string_agg",
    """SELECT p_brand, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS types FROM part GROUP BY 1""",
)
def ordered_string_agg(spark, d):
    return summaries.ordered_text(table(spark, d, "part"), ["p_brand"], "p_type", "types")


@query(
    "first_three_months",
    """SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month FROM orders ORDER BY 1 LIMIT 3""",
)
def first_three_months(spark, d):
    months = table(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    return summaries.first_values(months, "month", 3)


@query(
    "latest_month_rows",
    """SELECT o_orderstatus, count(*) AS orders FROM orders WHERE strftime(o_orderdate, '%Y-%m') = (SELECT max(strftime(o_orderdate, '%Y-%m')) FROM orders) GROUP BY 1""",
)
def latest_month_rows(spark, d):
    orders = table(spark, d, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    counts = orders.groupBy("month", "o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))
    return counts.filter(F.col("month") == orders.agg(F.max("month")).scalar()).drop("month")


@query(
    "catch_all_member",
    """WITH c AS (SELECT CAST(o_orderdate AS DATE) AS day, o_orderstatus AS status, count(*) AS orders FROM orders GROUP BY 1, 2)
    SELECT * FROM c UNION ALL SELECT DISTINCT day, 'all', CAST(NULL AS BIGINT) FROM c""",
)
def catch_all_member(spark, d):
    counts = table(spark, d, "orders").groupBy(
        F.col("o_orderdate").cast("date").alias("day"), F.col("o_orderstatus").alias("status")
    ).agg(F.count(F.lit(1)).alias("orders"))
    return summaries.with_catch_all(counts, "day", {"status": "all"})


@query(
    "top_k",
    """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""",
)
def top_k(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(100)


@query(
    "union_distinct",
    """SELECT c_nationkey AS nation, 'party' AS kind FROM customer UNION SELECT s_nationkey, 'party' FROM supplier UNION SELECT n_nationkey, 'nation' FROM nation""",
)
def union_distinct(spark, d):
    parts = [("customer", "c_nationkey", "party"), ("supplier", "s_nationkey", "party"), ("nation", "n_nationkey", "nation")]
    return reshape.union_distinct(
        [table(spark, d, t).select(F.col(c).alias("nation"), F.lit(k).alias("kind")) for t, c, k in parts]
    )


@query(
    "union_all",
    """SELECT c_nationkey AS nation, c_acctbal AS balance FROM customer UNION ALL SELECT s_nationkey, s_acctbal FROM supplier""",
)
def union_all(spark, d):
    return reshape.union_all(
        [
            table(spark, d, t).select(F.col(f"{p}_nationkey").alias("nation"), F.col(f"{p}_acctbal").alias("balance"))
            for t, p in (("customer", "c"), ("supplier", "s"))
        ]
    )


@query(
    "harmonised_union",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, 0 AS size, 'missing' AS brand FROM customer
    UNION ALL SELECT p_partkey, p_name, 'missing', p_size, p_brand FROM part""",
)
def harmonised_union(spark, d):
    left = table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    right = table(spark, d, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("size"), F.col("p_brand").alias("brand")
    )
    return reshape.harmonised_union(left, right, typed_defaults=True)


@query(
    "melt",
    """SELECT l_orderkey, l_linenumber, l_partkey, unnest(['l_quantity', 'l_extendedprice', 'l_discount']) AS variable,
      unnest([l_quantity, l_extendedprice, l_discount + 0.0]) AS value FROM lineitem""",
)
def melt(spark, d):
    lines = table(spark, d, "lineitem").withColumn("l_discount", F.col("l_discount") + F.lit(0.0))
    return reshape.melt(lines, ["l_orderkey", "l_linenumber", "l_partkey"], ["l_quantity", "l_extendedprice", "l_discount"])


@query(
    "one_hot",
    """SELECT c_custkey, CAST(c_mktsegment = 'AUTOMOBILE' AS INT) AS seg_automobile, CAST(c_mktsegment = 'BUILDING' AS INT) AS seg_building,
      CAST(c_mktsegment = 'FURNITURE' AS INT) AS seg_furniture, CAST(c_mktsegment = 'HOUSEHOLD' AS INT) AS seg_household,
      CAST(c_mktsegment = 'MACHINERY' AS INT) AS seg_machinery FROM customer""",
)
def one_hot(spark, d):
    customers = table(spark, d, "customer")
    segments = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    return coding.one_hot(customers, "c_mktsegment", segments, "seg_").select(
        "c_custkey", *[f"seg_{s.lower()}" for s in segments]
    )


CALENDAR = """days AS (SELECT CAST(unnest(generate_series((SELECT CAST(min(o_orderdate) AS TIMESTAMP) FROM orders),
  (SELECT CAST(max(o_orderdate) AS TIMESTAMP) FROM orders), INTERVAL 1 DAY)) AS DATE) AS day)"""


def order_calendar(spark, d, fiscal=None):
    orders = table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    return cal.calendar_dimension(panels.day_bounds(orders, F.col("day")), fiscal)


@query(
    "calendar_dim",
    f"""WITH {CALENDAR} SELECT day, year(day) * 10000 + month(day) * 100 + day(day) AS date_key, year(day) AS year, quarter(day) AS quarter, month(day) AS month,
      strftime(day, '%B') AS month_name, strftime(day, '%Y-%m') AS month_key, day(day) AS day_of_month, dayofyear(day) AS day_of_year,
      dayofweek(day) + 1 AS day_of_week, isodow(day) - 1 AS weekday_number, strftime(day, '%A') AS weekday_name, weekofyear(day) AS week_of_year,
      CASE WHEN isodow(day) >= 6 THEN 1 ELSE 0 END AS is_weekend, CASE WHEN last_day(day) = day THEN 1 ELSE 0 END AS is_month_end,
      year(day) + CASE WHEN month(day) >= 4 THEN 1 ELSE 0 END AS fiscal_year, (month(day) + 8) % 12 + 1 AS fiscal_period,
      (month(day) + 8) % 12 // 3 + 1 AS fiscal_quarter, year(day) + CASE WHEN month(day) >= 10 THEN 1 ELSE 0 END AS budget_year,
      (month(day) + 2) % 12 + 1 AS budget_period, (month(day) + 2) % 12 // 3 + 1 AS budget_quarter FROM days""",
)
def calendar_dim(spark, d):
    return order_calendar(spark, d, {"fiscal": 4, "budget": 10})


EFFECTS = f"""{CALENDAR}, c AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY 1),
joined AS (SELECT day, orders, CASE WHEN month(day) = 12 AND day(day) = 25 THEN 1 ELSE 0 END AS holiday FROM days LEFT JOIN c USING (day)),
effects AS (SELECT day, CASE WHEN sum(holiday) OVER (ORDER BY day ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) > 0 THEN 1 ELSE 0 END AS near_holiday,
  CASE WHEN orders >= (SELECT quantile_disc(orders, 0.95) FROM joined) THEN 1 ELSE 0 END AS busy,
  CASE WHEN isodow(day) = 1 THEN 1 ELSE 0 END AS monday, CASE WHEN isodow(day) = 7 THEN 1 ELSE 0 END AS sunday FROM joined)"""


def _effects(spark, d):
    orders = table(spark, d, "orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    days = cut_lineage(order_calendar(spark, d).select("day").join(orders, "day", "left"))
    holiday = coding.flag((F.month("day") == 12) & (F.dayofmonth("day") == 25))
    return cal.calendar_effects(days.withColumn("holiday", holiday), "holiday", {"busy": ("orders", "0.95")})


@query("calendar_effects", f"WITH {EFFECTS} SELECT * FROM effects")
def calendar_effects(spark, d):
    return _effects(spark, d).select("day", "near_holiday", "busy", "monday", "sunday")


@query(
    "melted_calendar",
    f"""WITH {EFFECTS} SELECT day, unnest(['near_holiday', 'busy', 'monday', 'sunday']) AS effect, unnest([near_holiday, busy, monday, sunday]) AS value FROM effects""",
)
def melted_calendar(spark, d):
    return cal.melted_calendar(_effects(spark, d), ["near_holiday", "busy", "monday", "sunday"])


@query(
    "pressure_flags",
    """WITH c AS (SELECT CAST(ts AS DATE) AS day, count(*) FILTER (WHERE event_type = 'error') AS errors, count(*) FILTER (WHERE event_type = 'signup') AS signups FROM events GROUP BY 1),
    p AS (SELECT day, errors, signups, CASE WHEN errors >= (SELECT quantile_disc(errors, 0.8) FROM c) THEN 1 ELSE 0 END AS error_peak,
      CASE WHEN signups >= (SELECT quantile_disc(signups, 0.8) FROM c) THEN 1 ELSE 0 END AS signup_peak FROM c)
    SELECT day, errors, signups, error_peak, signup_peak,
      CASE WHEN error_peak = 0 AND sum(error_peak) OVER (ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) > 0 THEN 1 ELSE 0 END AS error_peak_recent,
      CASE WHEN signup_peak = 0 AND sum(signup_peak) OVER (ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) > 0 THEN 1 ELSE 0 END AS signup_peak_recent,
      CASE WHEN error_peak = 1 OR signup_peak = 1 THEN 1 ELSE 0 END AS any_peak FROM p""",
)
def pressure_flags(spark, d):
    counts = table(spark, d, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(
        F.count_if(F.col("event_type") == "error").alias("errors"), F.count_if(F.col("event_type") == "signup").alias("signups")
    )
    counts = cut_lineage(counts)
    return cal.pressure_flags(counts.select("day"), counts, {"errors": "error", "signups": "signup"}, "0.8")


@query(
    "row_totals",
    """SELECT doc_id, coalesce(quality, 0) + coalesce(toxic, 0) AS flags, CASE WHEN quality IS NULL THEN 'unlabelled' ELSE 'labelled' END AS state
    FROM documents LEFT JOIN labels USING (doc_id)""",
)
def row_totals(spark, d):
    joined = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    state = F.when(F.col("quality").isNull(), "unlabelled").otherwise("labelled")
    return joined.select("doc_id", coding.flag_total(["quality", "toxic"]).alias("flags"), state.alias("state"))


@query(
    "drop_incomplete_rows",
    """SELECT lang, count(*) AS documents FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL AND toxic IS NOT NULL GROUP BY 1""",
)
def drop_incomplete_rows(spark, d):
    joined = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id", "left")
    return joined.dropna(subset=["quality", "toxic"]).groupBy("lang").agg(F.count(F.lit(1)).alias("documents"))


@query(
    "surrogate_ids",
    """SELECT sha256(CAST(user_id AS VARCHAR) || '|' || event_type) AS row_id, user_id, event_type, count(*) AS n FROM events GROUP BY 2, 3""",
)
def surrogate_ids(spark, d):
    pairs = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return pairs.withColumn("row_id", F.sha2(F.concat_ws("|", F.col("user_id").cast("string"), "event_type"), 256))


@query(
    "constant_placeholder",
    """SELECT event_type, 'single value' AS year, n FROM (SELECT event_type, count(*) AS n FROM events GROUP BY 1)""",
)
def constant_placeholder(spark, d):
    counts = table(spark, d, "events").groupBy("event_type", F.year("ts").cast("string").alias("year")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return coding.constant_placeholder(counts, ["event_type", "year"], "single value")


@query(
    "json_flatten",
    """SELECT event_id, user_id, event_type, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events""",
)
def json_flatten(spark, d):
    from lakeops.sources.bus import flatten_body

    events = table(spark, d, "events").select("event_id", "user_id", "event_type", F.col("props").cast("binary").alias("body"))
    return flatten_body(events, "k int")


@query(
    "epoch_columns",
    """SELECT event_id, date_trunc('milliseconds', ts) AS from_ms, date_trunc('microseconds', ts) AS from_ns FROM events""",
)
def epoch_columns(spark, d):
    from lakeops.functions.clock import epoch_micros, from_epoch

    micros = epoch_micros(F.col("ts"))
    return table(spark, d, "events").select(
        "event_id",
        from_epoch(F.call_function("div", micros, F.lit(1000)), "ms").cast("timestamp_ntz").alias("from_ms"),
        from_epoch(micros * 1000, "ns").cast("timestamp_ntz").alias("from_ns"),
    )


# The oracle inverts by the textbook fixed-point iteration, the operator by a series.
_E, _N, _F, _R = _parameters(conic_zone_cc(45))
_STEPS = ",\n".join(
    f"s{i + 1} AS (SELECT *, pi() / 2 - 2 * atan(t * pow((1 - {_E!r}::DOUBLE * sin(p{i})) / (1 + {_E!r}::DOUBLE * sin(p{i})), {_E / 2!r}::DOUBLE)) AS p{i + 1} FROM s{i})"
    for i in range(7)
)


@query(
    "projected_coordinates",
    f"""WITH xy AS (SELECT s_suppkey, 1650000::DOUBLE + s_nationkey * 1000 - 1700000.0 AS dx, {_R!r}::DOUBLE - (4180000.0 + s_suppkey * 10 - 4200000.0) AS dy FROM supplier),
    s0 AS (SELECT s_suppkey, degrees(atan2(dx, dy) / {_N!r}::DOUBLE) + 3 AS lon, pow(sqrt(dx * dx + dy * dy) / {6378137.0 * _F!r}::DOUBLE, {1 / _N!r}::DOUBLE) AS t,
      pi() / 2 - 2 * atan(pow(sqrt(dx * dx + dy * dy) / {6378137.0 * _F!r}::DOUBLE, {1 / _N!r}::DOUBLE)) AS p0 FROM xy), {_STEPS}
    SELECT s_suppkey, round(lon, 7) AS lon, round(degrees(p7), 7) AS lat FROM s7""",
)
def projected_coordinates(spark, d):
    x = F.lit(1_650_000.0) + F.col("s_nationkey") * 1_000
    y = F.lit(4_180_000.0) + F.col("s_suppkey") * 10
    lon, lat = to_lonlat(x, y, conic_zone_cc(45))
    return table(spark, d, "supplier").select("s_suppkey", F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat"))


@query(
    "entity_site_travel",
    """WITH p AS (SELECT DISTINCT user_id AS entity, event_type AS site FROM events), m AS (SELECT user_id AS entity, event_type AS site, max(value) AS distance FROM events WHERE value > 100 GROUP BY 1, 2)
    SELECT entity, site, coalesce(distance, 20.0) AS distance, CASE WHEN coalesce(distance, 20.0) <= 50 THEN 'near' WHEN coalesce(distance, 20.0) <= 250 THEN 'middle' ELSE 'far' END AS distance_band
    FROM p LEFT JOIN m USING (entity, site)""",
)
def entity_site_travel(spark, d):
    from lakeops.plans.attendance import travel_bands

    events = table(spark, d, "events").select(F.col("user_id").alias("entity"), F.col("event_type").alias("site"), "value")
    matrix = events.filter(F.col("value") > 100).groupBy("entity", "site").agg(F.max("value").alias("distance"))
    return travel_bands(events, matrix, [(50, "near"), (250, "middle")], "far", 20.0)


@query(
    "scalar_functions",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) + 1 AS next_day, date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS age,
      CAST(o_orderdate - INTERVAL 1 MONTH AS DATE) AS month_before, last_day(CAST(o_orderdate AS DATE)) AS month_end,
      CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, o_orderdate + INTERVAL 90 SECOND AS later,
      right(o_orderpriority, 3) AS tail, split_part(o_orderpriority, '-', 1) AS head, lower(o_orderpriority) AS lowered,
      regexp_replace(o_orderpriority, '[A-Z]', 'x', 'g') AS masked, concat_ws('||', o_orderstatus, NULL, o_orderpriority) AS joined,
      sha256(o_orderpriority) AS hashed, base64(CAST(o_orderstatus AS BLOB)) AS encoded, o_orderkey % 12 + 1 AS modulo,
      o_orderkey / 4 AS quarter_part, trunc(o_totalprice)::BIGINT AS whole, weekofyear(o_orderdate) AS week FROM orders""",
)
def scalar_functions(spark, d):
    day = F.col("o_orderdate").cast("date")
    p, status, key = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_orderkey")
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.date_add(day, 1).alias("next_day"),
        F.datediff(day, F.lit("1995-01-01").cast("date")).alias("age"),
        F.add_months(day, -1).alias("month_before"),
        F.last_day(day).alias("month_end"),
        F.trunc(day, "month").alias("month_start"),
        (F.col("o_orderdate") + F.expr("make_interval(0, 0, 0, 0, 0, 0, 90)")).alias("later"),
        F.right(p, F.lit(3)).alias("tail"),
        F.substring_index(p, "-", 1).alias("head"),
        F.lower(p).alias("lowered"),
        F.regexp_replace(p, "[A-Z]", "x").alias("masked"),
        F.concat_ws("||", status, F.lit(None).cast("string"), p).alias("joined"),
        F.sha2(p, 256).alias("hashed"),
        F.base64(status.cast("binary")).alias("encoded"),
        (key % 12 + 1).alias("modulo"),
        (key / 4).alias("quarter_part"),
        F.col("o_totalprice").cast("bigint").alias("whole"),
        F.weekofyear("o_orderdate").alias("week"),
    )


@query(
    "clock_functions",
    """SELECT event_id, hour(ts) * 3600 + minute(ts) * 60 AS minute_s, strftime(ts, '%H:%M') AS clock, date_part('hour', ts) AS hour_part,
      hour(ts) * 100 + minute(ts) AS hhmm, year(ts) * 10000 + month(ts) * 100 + day(ts) + quarter(ts) AS day_number,
      epoch_us(ts) // 1000000 - epoch_us(CAST(CAST(ts AS DATE) AS TIMESTAMP)) // 1000000 AS into_day, strftime(ts, '%A %B') AS names,
      dayofweek(ts) + 1 AS sunday_first, isodow(ts) - 1 AS monday_zero, day(ts) + dayofyear(ts) AS day_sums, strftime(ts, '%Y-%m') AS month_key,
      strptime(strftime(ts, '%d/%m/%Y'), '%d/%m/%Y')::DATE AS parsed_day, make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS from_seconds FROM events""",
)
def clock_functions(spark, d):
    ts = F.col("ts")
    instant = ts.cast("timestamp")
    text = F.date_format(ts, "yyyy-MM-dd HH:mm")
    seconds = F.unix_seconds(instant)
    return table(spark, d, "events").select(
        "event_id",
        (F.unix_timestamp(text, "yyyy-MM-dd HH:mm") - F.unix_seconds(ts.cast("date").cast("timestamp"))).alias("minute_s"),
        F.from_unixtime(seconds, "HH:mm").alias("clock"),
        F.date_part(F.lit("HOUR"), ts).alias("hour_part"),
        (F.hour(ts) * 100 + F.minute(ts)).alias("hhmm"),
        (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts) + F.quarter(ts)).alias("day_number"),
        (seconds - F.unix_seconds(ts.cast("date").cast("timestamp"))).alias("into_day"),
        F.date_format(ts, "EEEE MMMM").alias("names"),
        F.dayofweek(ts).alias("sunday_first"),
        F.weekday(ts).alias("monday_zero"),
        (F.dayofmonth(ts) + F.dayofyear(ts)).alias("day_sums"),
        F.substring(ts.cast("date").cast("string"), 1, 7).alias("month_key"),
        F.to_date(F.date_format(ts, "dd/MM/yyyy"), "dd/MM/yyyy").alias("parsed_day"),
        F.timestamp_seconds(seconds).cast("timestamp_ntz").alias("from_seconds"),
    )


@query(
    "nested_functions",
    """SELECT user_id, count(DISTINCT event_type) AS kinds, max(CAST(json_extract_string(props, '$.k') AS INT)) AS largest_k,
      max(event_type[1:1]) AS last_initial, CAST(sum(length(upper(event_type))) AS BIGINT) AS letters,
      CAST(sum(CASE WHEN starts_with(event_type, 'c') OR event_type ILIKE 'VIEW%' THEN 1 ELSE 0 END) AS BIGINT) AS web,
      max(abs(CAST(trunc(value) AS INT) - 250)) AS spread, max('{"k":' || CAST(user_id AS VARCHAR) || '}') AS as_json,
      max([user_id, event_id][2]) AS second_item, max(round(value)) AS rounded FROM events GROUP BY 1""",
)
def nested_functions(spark, d):
    kind = F.col("event_type")
    return table(spark, d, "events").groupBy("user_id").agg(
        F.size(F.collect_set("event_type")).cast("long").alias("kinds"),
        F.max(F.from_json("props", "k int")["k"]).alias("largest_k"),
        F.max(F.substr(kind, F.lit(1), F.lit(1))).alias("last_initial"),
        F.sum(F.length(F.upper(F.concat(F.trim(kind), F.rtrim(F.lit("  ")))))).cast("long").alias("letters"),
        F.sum(F.when(F.startswith(kind, F.lit("c")) | kind.ilike("VIEW%"), 1).otherwise(0)).alias("web"),
        F.max(F.abs(F.col("value").cast("int") - 250)).alias("spread"),
        F.max(F.to_json(F.struct(F.col("user_id").alias("k")))).alias("as_json"),
        F.max(F.array("user_id", "event_id")[1]).alias("second_item"),
        F.max(F.round("value")).alias("rounded"),
    )
