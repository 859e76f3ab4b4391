"""Periods, contract and pay features, shift profiles, typologies with moves, supplements and calendar effects."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions.coding import flag
from lakeops.operators import intervals
from lakeops.plans import attendance, calendar as cal, people
from lakeops.registry.base import TYPES, money, panel, query, table
from lakeops.registry.marts import _week_off, typology_sql
from lakeops.registry.summarising import CALENDAR, order_calendar
from lakeops.registry.timelines import ISLANDS
from lakeops.session import cut_lineage


def _orders(spark, d):
    return table(spark, d, "orders").withColumn("on", F.col("o_orderdate").cast("date"))


def contracts(spark, d):
    """An order stands for a contract of some days; those of one customer overlap or leave gaps."""
    return _orders(spark, d).select(
        F.col("o_custkey").alias("entity"),
        F.col("on").alias("starts"),
        F.date_add("on", (F.col("o_orderkey") % 300).cast("int")).alias("ends"),
        F.concat(F.lit(" "), "o_orderpriority").alias("nature"),
        F.when(F.col("o_orderkey") % 3 == 0, 80).otherwise(100).alias("hours_percent"),
        F.col("o_orderkey").alias("number"),
    )


CONTRACTS = """contracts AS (
  SELECT o_custkey AS entity, CAST(o_orderdate AS DATE) AS starts, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 300 AS INTEGER) AS ends,
    o_orderpriority AS nature, CASE WHEN o_orderkey % 3 = 0 THEN 80 ELSE 100 END AS hours_percent, o_orderkey AS number FROM orders)"""


@query(
    "interval_union",
    f"""WITH {CONTRACTS}, o AS (SELECT DISTINCT entity, starts, ends FROM contracts),
    m AS (SELECT *, max(ends) OVER (PARTITION BY entity ORDER BY starts, ends ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM o),
    n AS (SELECT *, sum(CASE WHEN date_diff('day', reached, starts) <= 1 THEN 0 ELSE 1 END) OVER (PARTITION BY entity ORDER BY starts, ends) AS nth FROM m)
    SELECT entity, min(starts) AS starts, max(ends) AS ends FROM n GROUP BY entity, nth""",
)
def interval_union(spark, d):
    return intervals.union(contracts(spark, d), ["entity"], "starts", "ends")


@query(
    "one_state_periods",
    f"""WITH {CONTRACTS}, c AS (SELECT entity, starts AS p FROM contracts UNION SELECT entity, ends + 1 FROM contracts),
    s AS (SELECT entity, p, lead(p) OVER (PARTITION BY entity ORDER BY p) AS q FROM c),
    h AS (SELECT s.entity, p, q, nature, hours_percent FROM s JOIN contracts k ON k.entity = s.entity AND p BETWEEN starts AND ends
      QUALIFY row_number() OVER (PARTITION BY s.entity, p ORDER BY starts DESC, number DESC) = 1),
    g AS (SELECT *, CASE WHEN lag(q) OVER w = p AND lag(nature) OVER w = nature AND lag(hours_percent) OVER w = hours_percent THEN 0 ELSE 1 END AS new
      FROM h WINDOW w AS (PARTITION BY entity ORDER BY p)),
    r AS (SELECT *, sum(new) OVER (PARTITION BY entity ORDER BY p) AS run FROM g)
    SELECT entity, min(p) AS starts, CAST(max(q) - 1 AS DATE) AS ends, ' ' || any_value(nature) AS nature, any_value(hours_percent) AS hours_percent FROM r GROUP BY entity, run""",
)
def one_state_periods(spark, d):
    return intervals.one_state(contracts(spark, d), ["entity"], "starts", "ends", ["starts", "number"], ["nature", "hours_percent"])


KINDS = {"1-URGENT": "temporary", "2-HIGH": "temporary", "3-MEDIUM": "permanent", "5-LOW": "trainee"}


@query(
    "contract_features",
    f"""WITH {CONTRACTS}, d AS (SELECT DISTINCT o_custkey AS entity, CAST(o_orderdate AS DATE) + 20 AS day FROM orders),
    held AS (SELECT d.entity, d.day, nature, hours_percent, false AS carried FROM d JOIN contracts c ON c.entity = d.entity AND day BETWEEN starts AND ends
      QUALIFY row_number() OVER (PARTITION BY d.entity, day ORDER BY starts DESC, number DESC) = 1),
    past AS (SELECT d.entity, d.day, nature, hours_percent, true AS carried FROM d JOIN contracts c ON c.entity = d.entity AND ends < day
      QUALIFY row_number() OVER (PARTITION BY d.entity, day ORDER BY ends DESC, starts DESC, number DESC) = 1),
    s AS (SELECT d.entity, d.day, coalesce(h.nature, p.nature) AS nature, coalesce(h.hours_percent, p.hours_percent) AS hours,
        h.carried IS NULL AND p.carried IS NOT NULL AS carried
      FROM d LEFT JOIN held h ON h.entity = d.entity AND h.day = d.day LEFT JOIN past p ON p.entity = d.entity AND p.day = d.day),
    moves AS (SELECT o_custkey AS entity, CAST(o_orderdate AS DATE) AS since, max(o_orderkey % 25) AS place FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2),
    r AS (SELECT d.entity, d.day, arg_max(place, since) AS residence FROM d JOIN moves m ON m.entity = d.entity AND since <= day GROUP BY 1, 2),
    p AS (SELECT c_custkey AS entity, DATE '1950-01-01' + CAST(c_custkey * 37 % 18000 AS INTEGER) AS born, DATE '1990-01-01' + CAST(c_custkey % 3000 AS INTEGER) AS hired,
        CASE WHEN c_custkey % 3 > 0 THEN year(DATE '1970-06-01' + CAST(c_custkey % 9000 AS INTEGER)) END AS one,
        CASE WHEN c_custkey % 3 = 2 THEN year(DATE '1975-06-01' + CAST(c_custkey % 9000 AS INTEGER)) END AS two FROM customer),
    f AS (SELECT s.*, residence, CAST(floor(date_diff('day', hired, s.day) / 365) AS INTEGER) AS tenure_years, CAST(year(s.day) - year(born) AS INTEGER) AS age,
        CASE WHEN year(s.day) - one <= 20 THEN 1 ELSE 0 END + CASE WHEN year(s.day) - two <= 20 THEN 1 ELSE 0 END AS young
      FROM s LEFT JOIN r ON r.entity = s.entity AND r.day = s.day LEFT JOIN p ON p.entity = s.entity)
    SELECT entity, day, CASE WHEN nature IN ('1-URGENT', '2-HIGH') THEN 'temporary' WHEN nature = '3-MEDIUM' THEN 'permanent' WHEN nature = '5-LOW' THEN 'trainee' ELSE 'missing' END AS contract,
      carried AS contract_carried, CASE WHEN hours < 100 THEN 1 ELSE 0 END AS part_time, tenure_years,
      CASE WHEN tenure_years IS NULL THEN 'missing' WHEN tenure_years < 1 THEN 'under 1' WHEN tenure_years <= 5 THEN '1 to 5' ELSE 'over 5' END AS tenure_band, age,
      CASE WHEN age IS NULL THEN 'missing' WHEN age <= 30 THEN 'to 30' WHEN age <= 50 THEN '31 to 50' ELSE 'over 50' END AS age_band,
      young AS young_children, CASE WHEN young = 0 THEN 'none' WHEN young = 1 THEN 'one' ELSE 'more' END AS children_band, residence FROM f""",
)
def contract_features(spark, d):
    orders, key = _orders(spark, d), F.col("c_custkey")
    days = orders.select(F.col("o_custkey").alias("entity"), F.date_add("on", 20).alias("day")).distinct()
    day = lambda start, n: F.date_add(F.lit(start).cast("date"), n.cast("int"))
    children = F.array_compact(F.array(
        F.when(key % 3 > 0, day("1970-06-01", key % 9000)), F.when(key % 3 == 2, day("1975-06-01", key % 9000))
    ))
    persons = table(spark, d, "customer").select(
        key.alias("entity"), day("1950-01-01", key * 37 % 18000).alias("born"), day("1990-01-01", key % 3000).alias("hired"), children.alias("children")
    )
    homes = orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("entity"), F.col("on").alias("since"), (F.col("o_orderkey") % 25).alias("place"))
    return people.contract_features(
        days, contracts(spark, d), persons, homes, ["starts", "number"], KINDS,
        [(0, "under 1"), (5, "1 to 5")], "over 5", [(30, "to 30"), (50, "31 to 50")], "over 50", [(0, "none"), (1, "one")], "more",
    )


@query(
    "pay_features",
    """WITH p AS (SELECT o_custkey AS entity, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, sum(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE CAST(o_totalprice AS DECIMAL(18,2)) END) AS gross,
        max(CASE WHEN o_orderkey % 7 <> 0 THEN 100 + o_orderkey % 60 END) AS hours FROM orders GROUP BY 1, 2),
    med AS (SELECT quantile_disc(hours, 0.5) AS m FROM p),
    e AS (SELECT entity, month, CAST(gross AS DOUBLE) / CAST(coalesce(hours, m) AS DOUBLE) * CAST(m AS DOUBLE) AS pay FROM p, med),
    q AS (SELECT month, quantile_disc(pay, 0.3) AS low, quantile_disc(pay, 0.7) AS high FROM e GROUP BY 1),
    v AS (SELECT e.*, CASE WHEN pay <= low THEN 'low' WHEN pay >= high THEN 'high' ELSE 'middle' END AS level,
        CASE WHEN pay = lag(pay) OVER w THEN 0 ELSE 1 END AS new, coalesce(date_diff('day', lag(e.month) OVER w, e.month), 30) AS step
      FROM e JOIN q ON q.month = e.month WINDOW w AS (PARTITION BY entity ORDER BY e.month)),
    r AS (SELECT *, sum(new) OVER (PARTITION BY entity ORDER BY month) AS run FROM v),
    a AS (SELECT *, sum(step) OVER (PARTITION BY entity, run ORDER BY month) AS unchanged FROM r),
    c AS (SELECT entity, month, CASE WHEN pay <> 0 THEN struct_pack(pay := round(pay, 6), level := level,
        age := CASE WHEN unchanged < 190 THEN 'recent' WHEN unchanged >= 890 THEN 'old' ELSE 'between' END) END AS known FROM a),
    f AS (SELECT entity, month, coalesce(last_value(known IGNORE NULLS) OVER (PARTITION BY entity ORDER BY month ROWS UNBOUNDED PRECEDING),
        first_value(known IGNORE NULLS) OVER (PARTITION BY entity ORDER BY month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS k FROM c)
    SELECT entity, month, k.pay AS full_time_pay, coalesce(k.level, 'missing') AS level, coalesce(k.age, 'missing') AS change_age FROM f""",
)
def pay_features(spark, d):
    price = F.when(F.col("o_orderstatus") == "P", F.lit(0).cast("decimal(18,2)")).otherwise(money("o_totalprice"))
    hours = F.when(F.col("o_orderkey") % 7 != 0, 100 + F.col("o_orderkey") % 60)
    pay = _orders(spark, d).groupBy(F.col("o_custkey").alias("entity"), F.trunc("on", "month").alias("month")).agg(F.sum(price).alias("gross"), F.max(hours).alias("hours"))
    return people.pay_features(pay).withColumn("full_time_pay", F.round("full_time_pay", 6))


SHIFTS = """sv AS (SELECT user_id AS entity, CAST(ts AS DATE) AS day, hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS start_s, event_id FROM events),
se AS (SELECT *, (start_s + event_id % 700 * 60) % 86400 AS end_s FROM sv),
sh AS (SELECT entity, day, min(start_s) AS a, max(CASE WHEN end_s // 3600 < 4 THEN end_s + 86400 ELSE end_s END) AS b FROM se GROUP BY 1, 2),
shifts AS (SELECT entity, day, CAST(a // 3600 AS INTEGER) AS start_hour, CAST(b % 86400 // 3600 AS INTEGER) AS end_hour,
  CAST((b % 86400 // 3600 - a // 3600 + 24) % 24 AS INTEGER) AS span_hours FROM sh)"""


@query(
    "working_time_profile",
    f"""WITH {SHIFTS}, n AS (SELECT a.entity, a.day, a.start_hour, a.end_hour, a.span_hours,
      count(*) FILTER (WHERE b.span_hours <> 0 AND b.start_hour < 6) AS early, count(*) FILTER (WHERE b.span_hours <> 0 AND b.start_hour >= 6) AS later,
      count(*) FILTER (WHERE b.span_hours <> 0 AND b.span_hours <= 6) AS short, count(*) FILTER (WHERE b.span_hours > 6 AND b.span_hours < 12) AS usual, count(*) FILTER (WHERE b.span_hours >= 12) AS long
      FROM shifts a LEFT JOIN shifts b ON a.entity = b.entity AND b.day >= CAST(a.day - INTERVAL 3 MONTH AS DATE) AND b.day < a.day GROUP BY ALL),
    p AS (SELECT *, CASE WHEN early + later > 0 THEN CAST(early AS DOUBLE) / (early + later) END AS p1, CASE WHEN early + later > 0 THEN CAST(later AS DOUBLE) / (early + later) END AS p2,
      CASE WHEN short + usual + long > 0 THEN CAST(short AS DOUBLE) / (short + usual + long) END AS p3, CASE WHEN short + usual + long > 0 THEN CAST(usual AS DOUBLE) / (short + usual + long) END AS p4,
      CASE WHEN short + usual + long > 0 THEN CAST(long AS DOUBLE) / (short + usual + long) END AS p5 FROM n),
    f AS (SELECT entity, day, start_hour, end_hour, span_hours, coalesce(last_value(p1 IGNORE NULLS) OVER u, first_value(p1 IGNORE NULLS) OVER v) AS part_early,
      coalesce(last_value(p2 IGNORE NULLS) OVER u, first_value(p2 IGNORE NULLS) OVER v) AS part_later, coalesce(last_value(p3 IGNORE NULLS) OVER u, first_value(p3 IGNORE NULLS) OVER v) AS part_short,
      coalesce(last_value(p4 IGNORE NULLS) OVER u, first_value(p4 IGNORE NULLS) OVER v) AS part_usual, coalesce(last_value(p5 IGNORE NULLS) OVER u, first_value(p5 IGNORE NULLS) OVER v) AS part_long FROM p
      WINDOW u AS (PARTITION BY entity ORDER BY day ROWS UNBOUNDED PRECEDING), v AS (PARTITION BY entity ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT entity, day, start_hour, end_hour, span_hours, round(part_early, 9) AS part_early, round(part_long, 9) AS part_long, CASE WHEN part_early > 0.2 THEN 1 ELSE 0 END AS many_early,
      CASE WHEN part_short > 0.3 THEN 'many_short' WHEN part_long > 0.3 THEN 'many_long' ELSE 'usual' END AS spans FROM f""",
)
def working_time_profile(spark, d):
    start = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    services = table(spark, d, "events").select(
        F.col("user_id").alias("entity"), F.col("ts").cast("date").alias("day"), start.cast("long").alias("start_s"),
        ((start + F.col("event_id") % 700 * 60) % 86400).cast("long").alias("end_s"),
    )
    begins, span = F.col("start_hour"), F.col("span_hours")
    categories = {
        "start": {"early": begins < 6, "later": begins >= 6},
        "span": {"short": span <= 6, "usual": (span > 6) & (span < 12), "long": span >= 12},
    }
    flags = {"many_early": ("part_early", 0.2), "many_short": ("part_short", 0.3), "many_long": ("part_long", 0.3)}
    out = people.working_time_profile(services, categories, flags, {"spans": (["many_short", "many_long"], "usual")})
    return out.select(
        "entity", "day", "start_hour", "end_hour", "span_hours", F.round("part_early", 9).alias("part_early"), F.round("part_long", 9).alias("part_long"), "many_early", "spans"
    )


@query(
    "moves_typology",
    f"""WITH {ISLANDS}, f AS (SELECT a.entity, a.day, count(DISTINCT b.episode) FILTER (WHERE b.flag = 1) AS episodes, CAST(coalesce(sum(b.flag), 0) AS BIGINT) AS flagged_days
      FROM islands a LEFT JOIN islands b ON a.entity = b.entity AND b.day > CAST(a.day - INTERVAL 1 MONTH AS DATE) AND b.day <= a.day GROUP BY 1, 2),
    m AS (SELECT *, last_value(episodes) OVER w AS me, last_value(flagged_days) OVER w AS mf FROM f
      WINDOW w AS (PARTITION BY entity, date_trunc('month', day) ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
    s AS (SELECT entity, CASE WHEN entity % 3 = 0 THEN min(day) END AS starts, CASE WHEN entity % 4 = 0 THEN max(day) END AS ends FROM islands GROUP BY 1)
    SELECT m.entity, day, CASE WHEN starts > CAST(day - INTERVAL 1 MONTH AS DATE) AND starts <= day THEN 'entry'
      WHEN ends < CAST(day + INTERVAL 1 MONTH AS DATE) AND ends >= day THEN 'exit' ELSE {typology_sql('me', 'mf')} END AS typology FROM m JOIN s ON s.entity = m.entity""",
)
def moves_typology(spark, d):
    rows = attendance.episodes(attendance.bridge_off_days(panel(spark, d), _week_off()))
    spans = rows.groupBy("entity").agg(F.min("day").alias("first"), F.max("day").alias("last")).select(
        "entity", F.when(F.col("entity") % 3 == 0, F.col("first")).alias("starts"), F.when(F.col("entity") % 4 == 0, F.col("last")).alias("ends")
    )
    return people.moves_typology(rows, spans, TYPES, "many", months=1).select("entity", "day", "typology")


SUPPLEMENTS = """pd AS (SELECT o_custkey AS entity, CAST(o_orderdate AS DATE) AS day, o_orderpriority || '/' || o_orderstatus AS kind, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders),
nb AS (SELECT kind, CAST(row_number() OVER (ORDER BY count(*) DESC, kind) AS INTEGER) AS number FROM pd GROUP BY 1),
sup AS (SELECT d.entity, d.day, p.kind, CAST(sum(amount) AS DECIMAL(28,2)) AS amount_before, count(*) AS times_before FROM (SELECT DISTINCT entity, day FROM pd) d
  JOIN pd p ON p.entity = d.entity AND p.day > CAST(d.day - INTERVAL 10 MONTH AS DATE) AND p.day <= d.day GROUP BY 1, 2, 3)"""


def _supplements(spark, d):
    paid = _orders(spark, d).select(
        F.col("o_custkey").alias("entity"), F.col("on").alias("day"), F.concat_ws("/", "o_orderpriority", "o_orderstatus").alias("kind"), money("o_totalprice").alias("amount")
    )
    return people.supplement_lookback(paid, "kind", "amount", 10)


@query("bonus_supplements", f"WITH {SUPPLEMENTS} SELECT entity, day, kind, number, amount_before, times_before FROM sup JOIN nb USING (kind)")
def bonus_supplements(spark, d):
    out = _supplements(spark, d)
    return out.withColumns({"amount_before": F.col("amount_before").cast("decimal(28,2)"), "times_before": F.col("times_before").cast("long")})


@query(
    "wide_supplements",
    f"""WITH {SUPPLEMENTS} SELECT entity, day, max(CASE WHEN kind = '1-URGENT/F' THEN 1 ELSE 0 END) AS paid_1_urgent_f, max(CASE WHEN kind = '5-LOW/O' THEN 1 ELSE 0 END) AS paid_5_low_o
    FROM sup GROUP BY 1, 2""",
)
def wide_supplements(spark, d):
    return people.wide_supplements(_supplements(spark, d), "kind", ["1-URGENT/F", "5-LOW/O"])


@query(
    "all_calendar_effects",
    f"""WITH {CALENDAR}, c AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS flu, count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS cold,
        CAST(min(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS coldest, CAST(max(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS warmest FROM orders GROUP BY 1),
    j AS (SELECT day, coalesce(flu, 0) AS flu, coalesce(cold, 0) AS cold, coldest, warmest, CASE WHEN (month(day) = 12 AND day(day) = 25) OR dayofyear(day) = 1 THEN 1 ELSE 0 END AS holiday,
        CASE WHEN dayofyear(day) % 97 = 0 THEN 1 ELSE 0 END AS feast, CASE WHEN coldest < 2000 THEN 1 ELSE 0 END AS snow FROM days LEFT JOIN c USING (day)),
    p AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS starts, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 20 AS INTEGER) AS ends FROM orders WHERE o_orderkey % 97 = 0 AND o_orderkey % 3 = 1)
    SELECT day, CASE WHEN sum(holiday) OVER w > 0 THEN 1 ELSE 0 END AS near_holiday, CASE WHEN sum(feast) OVER w > 0 THEN 1 ELSE 0 END AS near_feast, CASE WHEN sum(snow) OVER w > 0 THEN 1 ELSE 0 END AS snowy,
      CASE WHEN flu >= (SELECT quantile_disc(flu, 0.9) FROM j) THEN 1 ELSE 0 END AS flu_peak, CASE WHEN cold >= (SELECT quantile_disc(cold, 0.9) FROM j) THEN 1 ELSE 0 END AS cold_peak,
      CASE WHEN flu >= (SELECT quantile_disc(flu, 0.9) FROM j) OR cold >= (SELECT quantile_disc(cold, 0.9) FROM j) THEN 1 ELSE 0 END AS epidemic,
      CASE WHEN coldest < 1500 OR warmest > 400000 THEN 1 ELSE 0 END AS extreme, CASE WHEN EXISTS (SELECT 1 FROM p WHERE day BETWEEN starts AND ends) THEN 1 ELSE 0 END AS in_period,
      CASE WHEN isodow(day) >= 6 THEN 1 ELSE 0 END AS weekend, CASE WHEN isodow(day) < 6 THEN 1 ELSE 0 END AS workday, CASE WHEN isodow(day) = 1 THEN 1 ELSE 0 END AS monday, CASE WHEN isodow(day) = 5 THEN 1 ELSE 0 END AS friday
    FROM j WINDOW w AS (ORDER BY day ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)""",
)
def all_calendar_effects(spark, d):
    orders, price = _orders(spark, d), money("o_totalprice")
    counts = orders.groupBy(F.col("on").alias("day")).agg(
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("flu"), F.count_if(F.col("o_orderpriority") == "5-LOW").alias("cold"),
        F.min(price).cast("double").alias("coldest"), F.max(price).cast("double").alias("warmest"),
    )
    days = cut_lineage(order_calendar(spark, d).select("day").join(counts, "day", "left").fillna(0, ["flu", "cold"]))
    days = days.withColumns({
        "holiday": flag(((F.month("day") == 12) & (F.dayofmonth("day") == 25)) | (F.dayofyear("day") == 1)),
        "feast": flag(F.dayofyear("day") % 97 == 0),
        "snow": flag(F.col("coldest") < 2000),
    })
    periods = orders.filter("o_orderkey % 97 = 0").select(
        (F.col("o_orderkey") % 3).cast("string").alias("zone"), F.col("on").alias("starts"), F.date_add("on", (F.col("o_orderkey") % 20).cast("int")).alias("ends")
    )
    out = cal.all_calendar_effects(
        days, {"near_holiday": "holiday", "near_feast": "feast", "snowy": "snow"}, {"flu_peak": ("flu", "0.9"), "cold_peak": ("cold", "0.9")},
        {"epidemic": ["flu_peak", "cold_peak"]}, {"extreme": ("coldest", 1500.0, "warmest", 400000.0)}, periods, "1",
    )
    return out.drop("flu", "cold", "coldest", "warmest", "holiday", "feast", "snow")
