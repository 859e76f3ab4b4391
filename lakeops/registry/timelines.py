"""Headways, punctuality, chains, fills, runs and rolling sums."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from lakeops.functions.coding import flag
from lakeops.operators import joins, timeline as tl
from lakeops.plans import attendance, service_quality as sq, topology
from lakeops.registry.base import CHAIN_POINTS, PANEL, PASSAGES, chain_points, panel, passages, query, second_of_day, table
from lakeops.registry.joining import HOUR_BANDS, hour_bands
from lakeops.registry.stars import RULES_SQL, rules


def _by_user():
    return tl.Timeline(("user_id",), ("ts", "event_id"), tl.ROWS)


def _headways(spark, d, **options):
    rows, keys = passages(spark, d), ["day", "line", "stop"]
    return sq.headways(
        rows, keys, ["ts", "event_id"], "planned_s", "deviation_s", chunk=tl.ROWS, **options
    )


HEADWAYS = f"""{PASSAGES},
lagged AS (SELECT *, planned_s - lag(planned_s) OVER w AS planned_headway,
    planned_s + deviation_s - lag(planned_s + deviation_s) OVER w AS actual_headway
  FROM passages WINDOW w AS (PARTITION BY day, line, stop ORDER BY ts, event_id))"""


@query(
    "headway",
    f"""WITH {HEADWAYS} SELECT event_id, day, line, stop, planned_headway, actual_headway,
      CASE WHEN abs(actual_headway) < planned_headway + 180 THEN 1 ELSE 0 END AS regular,
      CASE WHEN planned_headway IS NOT NULL THEN 1 ELSE 0 END AS counted FROM lagged""",
)
def headway(spark, d):
    return _headways(spark, d).select(
        "event_id", "day", "line", "stop", "planned_headway", "actual_headway", "regular", "counted"
    )


@query(
    "headway_rollup",
    f"""WITH {HEADWAYS}, {HOUR_BANDS},
    f AS (SELECT *, CASE WHEN abs(actual_headway) < planned_headway + 180 THEN 1 ELSE 0 END AS regular,
      CASE WHEN planned_headway IS NOT NULL THEN 1 ELSE 0 END AS counted FROM lagged)
    SELECT day, line, stop, band, CAST(sum(regular) AS BIGINT) AS regular, CAST(sum(counted) AS BIGINT) AS counted,
      CASE WHEN sum(counted) > 0 THEN round(CAST(sum(regular) AS DOUBLE) / sum(counted), 9) END AS regularity
    FROM f JOIN hour_bands ON hour(ts) * 3600 + minute(ts) * 60 + second(ts) BETWEEN band_from AND band_to
    WHERE NOT EXISTS (SELECT 1 FROM {RULES_SQL} WHERE r.line = f.line AND r.stop = f.stop)
    GROUP BY 1, 2, 3, 4""",
)
def headway_rollup(spark, d):
    banded = sq.with_band(_headways(spark, d), hour_bands(spark), second_of_day("ts"))
    out = sq.headway_rollup(banded, ["day", "line", "stop", "band"], rules(spark))
    return out.withColumn("regularity", F.round("regularity", 9))


@query(
    "headway_signed",
    f"""WITH {HEADWAYS} SELECT line, stop,
      CAST(sum(CASE WHEN actual_headway <= planned_headway + 179 THEN 1 ELSE 0 END) AS BIGINT) AS regular FROM lagged GROUP BY 1, 2""",
)
def headway_signed(spark, d):
    rows = _headways(spark, d, tolerance_s=179, absolute=False, inclusive=True)
    return rows.groupBy("line", "stop").agg(F.sum("regular").alias("regular"))


@query(
    "tram_headway",
    f"""WITH {HEADWAYS}, {HOUR_BANDS}
    SELECT line, band, CAST(sum(CASE WHEN actual_headway <= planned_headway + 59 THEN 1 ELSE 0 END) AS BIGINT) AS regular_59,
      CAST(sum(CASE WHEN actual_headway <= planned_headway + 119 THEN 1 ELSE 0 END) AS BIGINT) AS regular_119,
      CAST(sum(abs(actual_headway - planned_headway)) AS BIGINT) AS gap, count(*) AS passages
    FROM lagged JOIN hour_bands ON hour(ts) * 3600 + minute(ts) * 60 + second(ts) BETWEEN band_from AND band_to GROUP BY 1, 2""",
)
def tram_headway(spark, d):
    rows, keys = passages(spark, d), ["day", "line", "stop"]
    rows = sq.tolerance_headways(
        rows, keys, ["ts", "event_id"], "planned_s", "deviation_s", chunk=tl.ROWS
    )
    return sq.with_band(rows, hour_bands(spark), second_of_day("ts")).groupBy("line", "band").agg(
        F.sum("regular_59").alias("regular_59"),
        F.sum("regular_119").alias("regular_119"),
        F.sum("headway_gap").alias("gap"),
        F.count(F.lit(1)).alias("passages"),
    )


PUNCTUAL = f"""{PASSAGES}, sizes AS (SELECT user_id, count(DISTINCT line) AS chain_stops FROM passages GROUP BY 1),
ranked AS (SELECT p.*, chain_stops, row_number() OVER (PARTITION BY p.user_id, day ORDER BY ts, event_id) AS rank_in_trip,
    CASE WHEN deviation_s BETWEEN -59 AND 239 THEN 1 ELSE 0 END AS on_time
  FROM passages p JOIN sizes s ON s.user_id = p.user_id)"""


@query(
    "punctuality",
    f"""WITH {PUNCTUAL} SELECT event_id, rank_in_trip, chain_stops, on_time,
      CASE WHEN rank_in_trip <= chain_stops - 2 THEN 1 ELSE 0 END AS is_reference,
      CASE WHEN rank_in_trip <= chain_stops - 2 THEN on_time ELSE 0 END AS on_time_reference FROM ranked""",
)
def punctuality(spark, d):
    rows, trip = passages(spark, d), ["user_id", "day"]
    out = sq.punctuality(
        rows, trip, ["ts", "event_id"], ["user_id"], "line", "deviation_s", chunk=tl.ROWS
    )
    return out.select("event_id", "rank_in_trip", "chain_stops", "on_time", "is_reference", "on_time_reference")


@query(
    "terminus_punctuality",
    f"""WITH {PUNCTUAL} SELECT day, line, count(*) AS departures,
      CAST(sum(CASE WHEN deviation_s BETWEEN -59 AND 179 THEN 1 ELSE 0 END) AS BIGINT) AS on_time
    FROM ranked WHERE rank_in_trip = 1 GROUP BY 1, 2""",
)
def terminus_punctuality(spark, d):
    rows = passages(spark, d).select("user_id", "day", "ts", "event_id", "line", "deviation_s")
    first = sq.terminus_punctuality(rows, ["user_id", "day"], ["ts", "event_id"], "deviation_s")
    return first.groupBy("day", "line").agg(F.count(F.lit(1)).alias("departures"), F.sum("on_time").alias("on_time"))


@query(
    "monitored_punctuality",
    f"""WITH {PASSAGES}, {HOUR_BANDS}
    SELECT line, stop, band, CAST(sum(CASE WHEN deviation_s BETWEEN -59 AND 179 THEN 1 ELSE 0 END) AS BIGINT) AS on_time,
      count(*) AS passages, round(avg(CASE WHEN deviation_s BETWEEN -59 AND 179 THEN 1.0 ELSE 0.0 END), 9) AS punctuality
    FROM passages p JOIN hour_bands ON hour(ts) * 3600 + minute(ts) * 60 + second(ts) BETWEEN band_from AND band_to
    WHERE EXISTS (SELECT 1 FROM {RULES_SQL} WHERE r.line = p.line AND r.stop = p.stop) GROUP BY 1, 2, 3""",
)
def monitored_punctuality(spark, d):
    rows = sq.with_band(passages(spark, d), hour_bands(spark), second_of_day("ts"))
    out = sq.monitored_punctuality(rows, rules(spark), ["line", "stop"], "deviation_s", ["line", "stop", "band"])
    return out.withColumn("punctuality", F.round("punctuality", 9))


@query(
    "row_number_first",
    """SELECT user_id, event_id, event_type, rn FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)""",
)
def row_number_first(spark, d):
    events = table(spark, d, "events")
    return tl.along(events, _by_user(), {"rn": tl.position()}).select("user_id", "event_id", "event_type", "rn")


@query(
    "chain_without_tail",
    f"""WITH {CHAIN_POINTS}, r AS (SELECT chain, point_order, point, row_number() OVER (PARTITION BY chain ORDER BY point_order) AS rank,
      count(*) OVER (PARTITION BY chain) AS points_in_chain FROM chain_points)
    SELECT * FROM r WHERE rank <= points_in_chain - 2""",
)
def chain_without_tail(spark, d):
    points = chain_points(spark, d).drop("length")
    return sq.without_tail(points, ["chain"], ["point_order"])


TOPOLOGY = f"""{CHAIN_POINTS},
pairs AS (SELECT l_suppkey AS from_point, l_partkey AS to_point, CAST(max(l_quantity) AS BIGINT) AS distance FROM lineitem GROUP BY 1, 2),
linked AS (SELECT chain, point_order, point, lag(point, 1, 0) OVER (PARTITION BY chain ORDER BY point_order) AS previous_point FROM chain_points),
measured AS (SELECT l.*, distance AS leg FROM linked l LEFT JOIN pairs ON previous_point = from_point AND point = to_point),
topology AS (SELECT chain, point_order, point, previous_point, coalesce(leg, 0) AS leg,
  CAST(coalesce(sum(leg) OVER (PARTITION BY chain ORDER BY point_order RANGE UNBOUNDED PRECEDING), 0) AS BIGINT) AS distance_so_far,
  count(point) OVER (PARTITION BY chain) AS points_in_chain, count(point) OVER (PARTITION BY point_order) AS points_in_period FROM measured)"""


def _topology(spark, d):
    pairs = table(spark, d, "lineitem").groupBy(
        F.col("l_suppkey").alias("from_point"), F.col("l_partkey").alias("to_point")
    ).agg(F.max("l_quantity").cast("long").alias("distance"))
    return topology.chain_topology(
        chain_points(spark, d).drop("length"), pairs, ["chain"], "point_order", "point", ["point_order"]
    )


@query("chain_neighbours_cumulative", f"WITH {TOPOLOGY} SELECT * FROM topology")
def chain_neighbours_cumulative(spark, d):
    return _topology(spark, d)


@query(
    "termini",
    f"""WITH {TOPOLOGY} SELECT DISTINCT chain, point, point_order AS position FROM topology
    WHERE point_order = 1 OR point_order = points_in_chain""",
)
def termini(spark, d):
    sized = chain_points(spark, d).withColumn("points_in_chain", F.count("point").over(Window.partitionBy("chain")))
    return topology.termini(sized, ["chain"], "point", "point_order", "points_in_chain")


@query(
    "located_topology",
    f"""WITH {CHAIN_POINTS} SELECT chain, point_order, point, p_name, p_size AS x,
      CASE WHEN p_type LIKE 'E%' THEN 'T1' WHEN p_type LIKE '%MALL' THEN 'T2' WHEN p_type LIKE 'S%' THEN 'T3' END AS line_code
    FROM chain_points LEFT JOIN part ON point = p_partkey""",
)
def located_topology(spark, d):
    places = table(spark, d, "part").select(F.col("p_partkey").alias("point"), "p_name", F.col("p_size").alias("x"), "p_type")
    patterns = [("E%", "T1"), ("%MALL", "T2"), ("S%", "T3")]
    out = topology.located_topology(chain_points(spark, d).drop("length"), places, "point", patterns, "p_type", "line_code")
    return out.drop("p_type")


@query(
    "unified_topology",
    f"""WITH {CHAIN_POINTS} SELECT 'a' AS network, chain AS line, point FROM chain_points
    UNION SELECT 'b', s_nationkey, s_suppkey FROM supplier""",
)
def unified_topology(spark, d):
    from lakeops.operators.reshape import union_distinct

    a = chain_points(spark, d).select(F.lit("a").alias("network"), F.col("chain").alias("line"), "point")
    b = table(spark, d, "supplier").select(
        F.lit("b").alias("network"), F.col("s_nationkey").cast("bigint").alias("line"), F.col("s_suppkey").alias("point")
    )
    return union_distinct([a, b])


@query(
    "line_reference",
    """SELECT n_nationkey AS number, n_name AS label, g.r_name AS gis_label, t.c_n AS ticket_customers, 'bus' AS network
    FROM nation LEFT JOIN region g ON n_nationkey = g.r_regionkey
    LEFT JOIN (SELECT c_nationkey, count(*) AS c_n FROM customer GROUP BY 1) t ON n_nationkey = t.c_nationkey
    UNION SELECT b.r_regionkey, b.r_name, g.r_name, t.c_n, 'tram' FROM region b LEFT JOIN region g ON g.r_regionkey = b.r_regionkey
    LEFT JOIN (SELECT c_nationkey, count(*) AS c_n FROM customer GROUP BY 1) t ON b.r_regionkey = t.c_nationkey""",
)
def line_reference(spark, d):
    bus = table(spark, d, "nation").select(
        F.col("n_nationkey").alias("number"), F.col("n_name").alias("label"), F.lit("bus").alias("network")
    )
    tram = table(spark, d, "region").select(
        F.col("r_regionkey").alias("number"), F.col("r_name").alias("label"), F.lit("tram").alias("network")
    )
    gis = table(spark, d, "region").select(F.col("r_regionkey").alias("gis_number"), F.col("r_name").alias("gis_label"))
    ticket = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("ticket_number")).agg(
        F.count(F.lit(1)).alias("ticket_customers")
    )
    return topology.line_reference([bus, tram], gis, ticket, "number").drop("gis_number", "ticket_number")


@query(
    "distinct_over_partition",
    """SELECT o_orderkey, (SELECT count(DISTINCT i.o_orderpriority) FROM orders i WHERE i.o_custkey = o.o_custkey) AS kinds FROM orders o""",
)
def distinct_over_partition(spark, d):
    from lakeops.operators.summaries import distinct_counts

    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    kinds = distinct_counts(orders, ["o_custkey"], kinds="o_orderpriority")
    return orders.join(kinds, "o_custkey", "left").select("o_orderkey", "kinds")


DAYS = """d AS (SELECT CAST(ts AS DATE) AS day, count(*) FILTER (WHERE event_type = 'error') AS errors,
  CASE WHEN count(*) FILTER (WHERE event_type = 'error') >= 70 THEN 1 ELSE 0 END AS bad FROM events GROUP BY 1)"""


def _days(spark, d):
    errors = F.count_if(F.col("event_type") == "error")
    days = table(spark, d, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(errors.alias("errors"))
    return days.withColumn("bad", flag(F.col("errors") >= 70))


@query(
    "centered_any",
    f"""WITH {DAYS} SELECT day, bad, CASE WHEN sum(bad) OVER (ORDER BY day ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) > 0 THEN 1 ELSE 0 END AS near FROM d""",
)
def centered_any(spark, d):
    days = _days(spark, d)
    return days.select("day", "bad", tl.calendar_flag_nearby("day", "bad", 2, 2).alias("near"))


@query(
    "trailing_recent",
    f"""WITH {DAYS} SELECT day, bad, CASE WHEN bad = 0 AND sum(bad) OVER (ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) > 0 THEN 1 ELSE 0 END AS recent FROM d""",
)
def trailing_recent(spark, d):
    days = _days(spark, d)
    return days.select("day", "bad", tl.calendar_flag_recent("day", "bad", 2).alias("recent"))


@query(
    "rolling12_ytd",
    """WITH m AS (SELECT o_orderstatus AS cause, year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS n FROM orders GROUP BY 1, 2, 3)
    SELECT cause, year, month, CAST(sum(n) OVER (PARTITION BY cause ORDER BY year, month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS BIGINT) AS n12,
      CAST(sum(n) OVER (PARTITION BY cause, year ORDER BY month) AS BIGINT) AS ytd FROM m""",
)
def rolling12_ytd(spark, d):
    day = F.col("o_orderdate")
    months = table(spark, d, "orders").groupBy(
        F.col("o_orderstatus").alias("cause"), F.year(day).alias("year"), F.month(day).alias("month")
    ).agg(F.count(F.lit(1)).alias("n"))
    return months.select(
        "cause",
        "year",
        "month",
        tl.rolling_sum("n", ["cause"], ["year", "month"], 12).alias("n12"),
        tl.to_date_sum("n", ["cause", "year"], ["month"]).alias("ytd"),
    )


@query(
    "running_totals",
    """SELECT event_id, CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS DECIMAL(28,2)) AS running,
      CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY event_type ORDER BY CAST(ts AS DATE) RANGE UNBOUNDED PRECEDING) AS DECIMAL(28,2)) AS upto_day FROM events""",
)
def running_totals(spark, d):
    from lakeops.registry.base import money

    rows = table(spark, d, "events").withColumns({"day": F.col("ts").cast("date"), "v": money("value")})
    rows = tl.along(rows, tl.Timeline(("event_type",), ("ts", "event_id"), tl.ROWS), {"running": tl.running_total("v")})
    # Rows of one day are peers: sum them first, then run over days, of which there are few.
    days = rows.groupBy("event_type", "day").agg(F.sum("v").alias("day_total"))
    days = tl.along(days, tl.Timeline(("event_type",), ("day",)), {"upto_day": tl.running_total("day_total", peers_share=True)})
    return rows.join(days, ["event_type", "day"]).select("event_id", "running", "upto_day")


@query(
    "forward_fill",
    """WITH e AS (SELECT *, CASE WHEN event_type IN ('purchase', 'signup') THEN value END AS known FROM events)
    SELECT event_id, last_value(known IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS back,
      first_value(known IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ahead FROM e""",
)
def forward_fill(spark, d):
    known = F.when(F.col("event_type").isin("purchase", "signup"), F.col("value"))
    events = table(spark, d, "events")
    out = tl.along(events, _by_user(), {"back": tl.last_known(known), "ahead": tl.next_known(known)})
    return out.select("event_id", "back", "ahead")


@query(
    "two_sided_gap_fill",
    f"""WITH {PANEL}, k AS (SELECT *, CASE WHEN isodow(day) >= 6 AND flag = 0 THEN NULL ELSE flag END AS known FROM panel),
    f AS (SELECT *, last_value(known IGNORE NULLS) OVER (PARTITION BY entity ORDER BY day ROWS UNBOUNDED PRECEDING) AS b,
      first_value(known IGNORE NULLS) OVER (PARTITION BY entity ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS a FROM k)
    SELECT entity, day, flag, CASE WHEN known IS NULL AND b = 1 AND a = 1 THEN 1 ELSE flag END AS bridged FROM f""",
)
def two_sided_gap_fill(spark, d):
    rows = panel(spark, d).select("entity", "day", "flag").withColumn("raw", F.col("flag"))
    out = attendance.bridge_off_days(rows, F.weekday("day") >= 5)
    return out.select("entity", "day", F.col("raw").alias("flag"), F.col("flag").alias("bridged"))


@query(
    "fill_both_ways",
    """WITH e AS (SELECT *, CASE WHEN event_type = 'signup' THEN value END AS known FROM events)
    SELECT event_id, coalesce(last_value(known IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING),
      first_value(known IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS filled FROM e""",
)
def fill_both_ways(spark, d):
    rows = table(spark, d, "events").withColumn("known", F.when(F.col("event_type") == "signup", F.col("value")))
    return tl.fill_both_ways(rows, _by_user(), "known", "filled").select("event_id", "filled")


ISLANDS = f"""{PANEL},
k AS (SELECT *, CASE WHEN isodow(day) >= 6 AND flag = 0 THEN NULL ELSE flag END AS known FROM panel),
g AS (SELECT *, last_value(known IGNORE NULLS) OVER (PARTITION BY entity ORDER BY day ROWS UNBOUNDED PRECEDING) AS b,
  first_value(known IGNORE NULLS) OVER (PARTITION BY entity ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS a FROM k),
bridged AS (SELECT entity, day, kind, n_events, amount, CASE WHEN known IS NULL AND b = 1 AND a = 1 THEN 1 ELSE flag END AS flag FROM g),
starts AS (SELECT *, CASE WHEN date_diff('day', lag(day) OVER w, day) = 1 AND kind = lag(kind) OVER w AND flag = 1 THEN 0 ELSE 1 END AS start
  FROM bridged WINDOW w AS (PARTITION BY entity ORDER BY day)),
islands AS (SELECT * EXCLUDE (start), CAST(sum(start) OVER (PARTITION BY entity ORDER BY day) AS BIGINT) AS episode FROM starts),
sized AS (SELECT *, min(day) OVER e AS first_day, max(day) OVER e AS last_day FROM islands WINDOW e AS (PARTITION BY entity, episode)),
measured AS (SELECT *, date_diff('day', first_day, last_day) + 1 AS length_days, date_diff('day', first_day, day) + 1 AS days_so_far,
  CASE WHEN flag = 0 THEN 'none' WHEN date_diff('day', first_day, last_day) + 1 <= 1 THEN '1 day'
    WHEN date_diff('day', first_day, last_day) + 1 <= 3 THEN '2 to 3 days' WHEN date_diff('day', first_day, last_day) + 1 <= 7 THEN '4 to 7 days'
    WHEN date_diff('day', first_day, last_day) + 1 <= 31 THEN '8 days to 1 month' WHEN date_diff('day', first_day, last_day) + 1 <= 93 THEN '1 to 3 months'
    ELSE 'over 3 months' END AS length_class FROM sized)"""


@query("islands", f"WITH {ISLANDS} SELECT entity, day, episode FROM islands")
def islands(spark, d):
    rows = attendance.bridge_off_days(panel(spark, d), F.weekday("day") >= 5)
    return attendance.episodes(rows).select("entity", "day", "episode")


@query(
    "island_lengths",
    f"""WITH {ISLANDS} SELECT entity, day, flag, kind, n_events, amount, episode, first_day, last_day, length_days, days_so_far, length_class,
      count(*) OVER (PARTITION BY day) AS headcount, strftime(day, '%Y-%m') AS month FROM measured""",
)
def island_lengths(spark, d):
    return attendance.episode_panel(panel(spark, d), F.weekday("day") >= 5)


@query(
    "event_runs",
    """WITH e AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR epoch_us(ts) - epoch_us(lag(ts) OVER w) > 7200000000
        OR event_type <> lag(event_type) OVER w THEN 1 ELSE 0 END AS start FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT event_id, CAST(sum(start) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS run FROM e""",
)
def event_runs(spark, d):
    from lakeops.functions.clock import epoch_micros

    events = table(spark, d, "events")

    def breaks(before, here):
        gap = epoch_micros(here("ts")) - epoch_micros(before("ts"))
        return (gap > 7_200_000_000) | (here("event_type") != before("event_type"))

    return tl.with_runs(events, _by_user(), "run", ["ts", "event_type"], breaks).select("event_id", "run")


@query(
    "value_runs",
    """WITH s AS (SELECT o_custkey AS entity, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, max(o_orderpriority) AS level FROM orders GROUP BY 1, 2),
    l AS (SELECT *, CASE WHEN level = lag(level) OVER w THEN 0 ELSE 1 END AS start, coalesce(date_diff('day', lag(month) OVER w, month), 30) AS step
      FROM s WINDOW w AS (PARTITION BY entity ORDER BY month)),
    r AS (SELECT *, CAST(sum(start) OVER (PARTITION BY entity ORDER BY month) AS BIGINT) AS run FROM l),
    g AS (SELECT *, CAST(sum(step) OVER (PARTITION BY entity, run ORDER BY month) AS BIGINT) AS days_unchanged FROM r)
    SELECT entity, month, level, run, days_unchanged,
      CASE WHEN days_unchanged < 190 THEN 'recent' WHEN days_unchanged >= 890 THEN 'old' ELSE 'between' END AS change_age FROM g""",
)
def value_runs(spark, d):
    series = table(spark, d, "orders").groupBy(
        F.col("o_custkey").alias("entity"), F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month")
    ).agg(F.max("o_orderpriority").alias("level"))
    return attendance.value_runs(series, "level", "month")


@query(
    "last_of_month",
    f"""WITH {PANEL} SELECT entity, day, last_value(n_events) OVER (PARTITION BY entity, date_trunc('month', day) ORDER BY day
      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS month_value FROM panel""",
)
def last_of_month(spark, d):
    from lakeops.operators.lookback import last_of_month as last

    return last(panel(spark, d), "entity", "day", "n_events", "month_value").select("entity", "day", "month_value")


@query(
    "partition_spread",
    """SELECT event_id, min(value) OVER (PARTITION BY user_id) AS lowest, max(value) OVER (PARTITION BY user_id) AS highest,
      count(*) OVER (PARTITION BY user_id) AS events FROM events""",
)
def partition_spread(spark, d):
    rows = joins.join_back(
        table(spark, d, "events"), ["user_id"], lowest=F.min("value"), highest=F.max("value"), events=F.count(F.lit(1))
    )
    return rows.select("event_id", "lowest", "highest", "events")
