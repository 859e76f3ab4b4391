"""Star joins, codes, clocks and validity."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions import clock, coding
from lakeops.functions.validity import validity_end, validity_start
from lakeops.operators import joins, summaries
from lakeops.plans import incidents, revenue, ticketing
from lakeops.registry.base import (
    PASSAGES, SALE_LINES, accounts, money, passages, products, query, sales, table,
)
from lakeops.session import local_table


@query(
    "star_left_counts",
    """SELECT CAST(o_orderdate AS DATE) AS day, p_type AS product, n_name AS line, count(*) AS validations
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN part ON l_partkey = p_partkey
    WHERE o_orderstatus IN ('F', 'O') AND c_mktsegment IN ('BUILDING', 'MACHINERY')
    GROUP BY 1, 2, 3""",
)
def star_left_counts(spark, d):
    dims = [
        (table(spark, d, "orders"), "l_orderkey", "o_orderkey"),
        (table(spark, d, "customer"), "o_custkey", "c_custkey"),
        (table(spark, d, "nation"), "c_nationkey", "n_nationkey"),
        (table(spark, d, "part"), "l_partkey", "p_partkey"),
    ]
    accepted = F.col("o_orderstatus").isin("F", "O") & F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    keys = {"day": F.col("o_orderdate").cast("date"), "product": F.col("p_type"), "line": F.col("n_name")}
    return ticketing.validations_by(table(spark, d, "lineitem"), dims, accepted, keys)


@query(
    "role_playing_dims",
    """SELECT cn.n_name AS customer_nation, sn.n_name AS supplier_nation, count(*) AS lines,
      CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS amount
    FROM nation cn JOIN customer ON cn.n_nationkey = c_nationkey RIGHT JOIN orders ON c_custkey = o_custkey
    JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation sn ON sn.n_nationkey = s_nationkey GROUP BY 1, 2""",
)
def role_playing_dims(spark, d):
    nation = table(spark, d, "nation")
    home = table(spark, d, "customer").join(nation, F.col("n_nationkey") == F.col("c_nationkey"))
    home = home.select("c_custkey", F.col("n_name").alias("customer_nation"))
    seller = table(spark, d, "supplier").join(nation, F.col("n_nationkey") == F.col("s_nationkey"))
    seller = seller.select("s_suppkey", F.col("n_name").alias("supplier_nation"))
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    orders = home.join(orders, F.col("c_custkey") == F.col("o_custkey"), "right").select("o_orderkey", "customer_nation")
    lines = table(spark, d, "lineitem").join(seller, F.col("l_suppkey") == F.col("s_suppkey"))
    # The fact is shuffled once, by order; the sums after it are combined before they are.
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("customer_nation", "supplier_nation").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(money("l_extendedprice")).cast("decimal(18,2)").alias("amount")
    )


@query(
    "code_map",
    """SELECT CASE p_type WHEN 'ECONOMY' THEN '59' WHEN 'LARGE' THEN '60' WHEN 'MEDIUM' THEN '61'
        WHEN 'PROMO' THEN '62' ELSE p_brand END AS line_code, count(*) AS parts, max(p_size) AS largest
    FROM part GROUP BY 1""",
)
def code_map(spark, d):
    code = coding.code_map(
        F.col("p_type"), {"ECONOMY": "59", "LARGE": "60", "MEDIUM": "61", "PROMO": "62"}, F.col("p_brand")
    )
    return table(spark, d, "part").groupBy(code.alias("line_code")).agg(
        F.count(F.lit(1)).alias("parts"), F.max("p_size").alias("largest")
    )


@query(
    "flag_decode",
    """SELECT CASE l_returnflag WHEN 'R' THEN 'returned' WHEN 'A' THEN 'accepted' ELSE '' END AS outcome,
      CASE l_linestatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'closed' ELSE '' END AS state, count(*) AS lines
    FROM lineitem
    WHERE CASE l_returnflag WHEN 'R' THEN 'returned' WHEN 'A' THEN 'accepted' ELSE '' END <> 'accepted'
    GROUP BY 1, 2""",
)
def flag_decode(spark, d):
    outcome = coding.decode_flag(F.col("l_returnflag"), {"R": "returned", "A": "accepted"})
    state = coding.decode_flag(F.col("l_linestatus"), {"O": "open", "F": "closed"})
    lines = table(spark, d, "lineitem").select(outcome.alias("outcome"), state.alias("state"))
    return lines.filter(F.col("outcome") != "accepted").groupBy("outcome", "state").agg(F.count(F.lit(1)).alias("lines"))


RULES = [("click", 1), ("click", 5), ("view", 2), ("view", 3), ("purchase", 0), ("error", 19)]
RULES_SQL = "(VALUES " + ", ".join(f"('{a}', {b})" for a, b in RULES) + ") r(line, stop)"


def rules(spark):
    return local_table(spark, RULES, "line string, stop bigint")


@query(
    "rule_table_filter",
    f"""WITH {PASSAGES}
    SELECT 'kept' AS side, line, stop, count(*) AS passages FROM passages p
    WHERE EXISTS (SELECT 1 FROM {RULES_SQL} WHERE r.line = p.line AND r.stop = p.stop) GROUP BY 2, 3
    UNION ALL
    SELECT 'dropped', line, stop, count(*) FROM passages p
    WHERE NOT EXISTS (SELECT 1 FROM {RULES_SQL} WHERE r.line = p.line AND r.stop = p.stop) GROUP BY 2, 3""",
)
def rule_table_filter(spark, d):
    counts = passages(spark, d).groupBy("line", "stop").agg(F.count(F.lit(1)).alias("passages"))
    kept = joins.rule_filter(counts, rules(spark), ["line", "stop"]).withColumn("side", F.lit("kept"))
    dropped = joins.rule_filter(counts, rules(spark), ["line", "stop"], exclude=True)
    return kept.unionByName(dropped.withColumn("side", F.lit("dropped")))


@query(
    "predicates",
    """SELECT count(*) FILTER (WHERE o_totalprice BETWEEN 1000 AND 50000) AS between_bounds,
      count(*) FILTER (WHERE o_orderstatus IN ('F', 'P')) AS in_list,
      count(*) FILTER (WHERE o_orderpriority LIKE '1%') AS like_prefix,
      count(*) FILTER (WHERE o_orderpriority ILIKE '%urg%') AS ilike_part,
      count(*) FILTER (WHERE regexp_matches(o_orderpriority, '^[2-3]')) AS regex_match,
      count(*) FILTER (WHERE starts_with(o_orderpriority, '5')) AS starts_with,
      count(*) FILTER (WHERE o_orderdate >= '1996-01-01' AND o_orderdate < '1997-02-01') AS date_bounds,
      count(*) FILTER (WHERE o_orderstatus IS NOT NULL) AS not_null
    FROM orders""",
)
def predicates(spark, d):
    p, day = F.col("o_orderpriority"), F.col("o_orderdate")
    tests = {
        "between_bounds": F.col("o_totalprice").between(1000, 50000),
        "in_list": F.col("o_orderstatus").isin("F", "P"),
        "like_prefix": p.like("1%"),
        "ilike_part": p.ilike("%urg%"),
        "regex_match": p.rlike("^[2-3]"),
        "starts_with": p.startswith("5"),
        "date_bounds": (day >= F.lit("1996-01-01").cast("timestamp_ntz")) & (day < F.lit("1997-02-01").cast("timestamp_ntz")),
        "not_null": F.col("o_orderstatus").isNotNull(),
    }
    return table(spark, d, "orders").agg(*[F.count_if(c).alias(n) for n, c in tests.items()])


@query(
    "band_labels",
    """SELECT CASE WHEN o_totalprice <= 10000 THEN 'small' WHEN o_totalprice <= 100000 THEN 'medium'
        WHEN o_totalprice <= 300000 THEN 'large' ELSE 'huge' END AS size_band, count(*) AS orders,
      CAST(sum(CASE WHEN o_totalprice <= 10000 THEN 1 ELSE 0 END) AS BIGINT) AS small_orders
    FROM orders GROUP BY 1""",
)
def band_labels(spark, d):
    price = F.col("o_totalprice")
    label = coding.band(price, [(10_000, "small"), (100_000, "medium"), (300_000, "large")], "huge")
    return table(spark, d, "orders").groupBy(label.alias("size_band")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(coding.flag(price <= 10_000)).alias("small_orders")
    )


@query(
    "typology_rules",
    """WITH c AS (SELECT o_custkey, count(*) AS n, count(DISTINCT CAST(o_orderdate AS DATE)) AS days FROM orders GROUP BY 1)
    SELECT CASE WHEN n <= 0 AND days >= 0 THEN 'none' WHEN n <= 2 AND days BETWEEN 0 AND 4 THEN 'few short' WHEN n <= 2 AND days > 4 THEN 'few long' WHEN n <= 6 AND days >= 0 THEN 'some' ELSE 'many' END AS typology, count(*) AS customers
    FROM c GROUP BY 1""",
)
def typology_rules(spark, d):
    from lakeops.plans.attendance import typology
    from lakeops.registry.base import TYPES

    per_day = table(spark, d, "orders").groupBy("o_custkey", F.col("o_orderdate").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("n")
    )
    per_customer = per_day.groupBy("o_custkey").agg(F.sum("n").alias("n"), F.count("day").alias("days"))
    return per_customer.groupBy(typology(F.col("n"), F.col("days"), TYPES, "many").alias("typology")).agg(
        F.count(F.lit(1)).alias("customers")
    )


@query(
    "multi_code_class",
    """SELECT CASE WHEN l_returnflag IN ('R') THEN 'return' WHEN l_linestatus IN ('O') THEN 'pending'
        WHEN l_returnflag IN ('A', 'N') THEN 'done' ELSE 'other' END AS class,
      CASE WHEN l_quantity <= 20 THEN 1 ELSE 0 END + CASE WHEN l_discount <= 0.02 THEN 1 ELSE 0 END
        + CASE WHEN l_tax <= 0.02 THEN 1 ELSE 0 END AS low_measures, count(*) AS lines
    FROM lineitem GROUP BY 1, 2""",
)
def multi_code_class(spark, d):
    klass = coding.classify_codes(
        [("l_returnflag", "return", ["R"]), ("l_linestatus", "pending", ["O"]), ("l_returnflag", "done", ["A", "N"])], "other"
    )
    marked = table(spark, d, "lineitem").select(
        klass.alias("class"),
        (coding.flag(F.col("l_quantity") <= 20) + coding.count_where(["l_discount", "l_tax"], lambda c: c <= 0.02)).alias(
            "low_measures"
        ),
    )
    return marked.groupBy("class", "low_measures").agg(F.count(F.lit(1)).alias("lines"))


@query(
    "null_defaults",
    f"""WITH {SALE_LINES}
    SELECT coalesce(valid_from, DATE '1970-01-01') AS valid_from, count(*) AS lines,
      count(*) FILTER (WHERE valid_from IS NOT NULL AND valid_to IS NOT NULL) AS complete,
      CAST(sum(coalesce(valid_to - sold_on, 0)) AS BIGINT) AS days
    FROM lines GROUP BY 1""",
)
def null_defaults(spark, d):
    rows = sales(spark, d).withColumn("days", F.datediff("valid_to", "sold_on")).fillna(0, ["days"])
    whole = F.col("valid_from").isNotNull() & F.col("valid_to").isNotNull()
    return rows.groupBy(F.coalesce("valid_from", F.lit("1970-01-01").cast("date")).alias("valid_from")).agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(whole).alias("complete"), F.sum("days").alias("days")
    )


@query(
    "scale_repair",
    """SELECT CASE WHEN abs(round(c_acctbal)) > 500 THEN 'as stored' ELSE 'rescaled' END AS repair, count(*) AS customers,
      CAST(sum(CAST(CASE WHEN abs(round(c_acctbal)) > 500 THEN round(c_acctbal) ELSE round(c_acctbal) * 10 END AS BIGINT)) AS BIGINT) AS total
    FROM customer GROUP BY 1""",
)
def scale_repair(spark, d):
    rows = table(spark, d, "customer").withColumn("v", F.round("c_acctbal"))
    kind = F.when(F.abs("v") > 500, "as stored").otherwise("rescaled")
    return rows.groupBy(kind.alias("repair")).agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(coding.repair_scale(F.col("v"), 500, 10).cast("long")).alias("total"),
    )


@query(
    "decimal_comma_parse",
    """SELECT l_returnflag, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS amount,
      max(CAST(l_shipdate AS DATE)) AS last_day, count(*) AS lines FROM lineitem GROUP BY 1""",
)
def decimal_comma_parse(spark, d):
    text = table(spark, d, "lineitem").select(
        "l_returnflag",
        F.translate(money("l_extendedprice").cast("string"), ".", ",").alias("price"),
        F.date_format("l_shipdate", "dd/MM/yyyy").alias("day"),
    )
    return text.groupBy("l_returnflag").agg(
        F.sum(money(coding.decimal_comma(F.col("price")))).cast("decimal(18,2)").alias("amount"),
        F.max(coding.parse_date(F.col("day"), ["yyyy-MM-dd", "dd/MM/yyyy"])).alias("last_day"),
        F.count(F.lit(1)).alias("lines"),
    )


@query(
    "operating_day",
    """SELECT CAST(ts - INTERVAL 4 HOUR AS DATE) AS operating_day, event_type, count(*) AS events
    FROM events GROUP BY 1, 2""",
)
def operating_day(spark, d):
    return table(spark, d, "events").groupBy(clock.operating_day(F.col("ts")).alias("operating_day"), "event_type").agg(
        F.count(F.lit(1)).alias("events")
    )


@query(
    "service_clock",
    """SELECT event_id, lpad(CAST(hour(ts) + 24 * date_diff('day', CAST(ts - INTERVAL 4 HOUR AS DATE), CAST(ts AS DATE)) AS VARCHAR), 2, '0')
      || ':' || lpad(CAST(minute(ts) AS VARCHAR), 2, '0') AS clock FROM events""",
)
def service_clock(spark, d):
    ts = F.col("ts")
    return table(spark, d, "events").select("event_id", clock.service_clock(ts, clock.operating_day(ts)).alias("clock"))


@query(
    "duration_text",
    """WITH s AS (SELECT event_id, CAST(round(value * 600) AS BIGINT) AS sec FROM events)
    SELECT event_id, CASE WHEN sec // 3600 < 10 THEN '0' ELSE '' END || CAST(sec // 3600 AS VARCHAR) || ':'
        || lpad(CAST(sec % 3600 // 60 AS VARCHAR), 2, '0') AS duration,
      lpad(CAST(sec % 86400 // 3600 AS VARCHAR), 2, '0') || ':' || lpad(CAST(sec % 3600 // 60 AS VARCHAR), 2, '0') AS wrapped
    FROM s""",
)
def duration_text(spark, d):
    start = F.col("ts").cast("timestamp")
    end = F.timestamp_micros(F.unix_micros(start) + F.round(F.col("value") * 600).cast("long") * 1_000_000)
    return table(spark, d, "events").select(
        "event_id",
        clock.duration_text(start, end).alias("duration"),
        clock.duration_text(start, end, wrap=True).alias("wrapped"),
    )


@query(
    "time_of_day_text",
    """SELECT event_id, strftime(ts, '%H:%M') AS from_seconds, strftime(ts, '%H:%M') AS from_text FROM events""",
)
def time_of_day_text(spark, d):
    from lakeops.registry.base import second_of_day

    return table(spark, d, "events").select(
        "event_id",
        clock.time_of_day_text(second_of_day("ts"), "seconds").alias("from_seconds"),
        clock.time_of_day_text(F.date_format("ts", "HH:mm:ss"), "text").alias("from_text"),
    )


@query(
    "shift_span",
    """WITH s AS (SELECT user_id, CAST(ts - INTERVAL 4 HOUR AS DATE) AS day,
        min(epoch_us(ts) // 1000000 - epoch_us(CAST(CAST(ts - INTERVAL 4 HOUR AS DATE) AS TIMESTAMP)) // 1000000) AS a,
        max(epoch_us(ts) // 1000000 - epoch_us(CAST(CAST(ts - INTERVAL 4 HOUR AS DATE) AS TIMESTAMP)) // 1000000) % 86400 AS b
      FROM events GROUP BY 1, 2)
    SELECT user_id, day, round(((CASE WHEN b // 3600 < 4 THEN b + 86400 ELSE b END) - a) / 3600, 4) AS span_hours,
      CAST(a // 3600 AS BIGINT) AS start_hour FROM s""",
)
def shift_span(spark, d):
    day = clock.operating_day(F.col("ts"))
    seconds = clock.duration_seconds(day, F.col("ts"))
    shifts = (
        table(spark, d, "events")
        .groupBy("user_id", day.alias("day"))
        .agg(F.min(seconds).alias("a"), (F.max(seconds) % 86400).alias("b"))
    )
    return shifts.select(
        "user_id",
        "day",
        clock.shift_span_hours(F.col("a"), F.col("b"), digits=4).alias("span_hours"),
        F.floor(F.col("a") / 3600).cast("long").alias("start_hour"),
    )


@query(
    "actual_time",
    f"""WITH {PASSAGES}
    SELECT event_id, make_timestamp((planned_s + deviation_s) * 1000000) AS actual FROM passages""",
)
def actual_time(spark, d):
    return passages(spark, d).select(
        "event_id", clock.actual_time(F.date_trunc("second", "ts"), F.col("deviation_s")).alias("actual")
    )


def _families():
    return F.col("family") == "annual", F.col("family") == "monthly"


def sale_lines(spark, d, aligned):
    annual, monthly = _families()
    return revenue.sale_lines(sales(spark, d), products(spark, d), annual, monthly, aligned)


@query(
    "validity_window",
    f"""WITH {SALE_LINES}
    SELECT 'plain' AS variant, family, plain_from AS business_from, plain_to AS business_to, count(*) AS lines
    FROM lines GROUP BY 2, 3, 4
    UNION ALL SELECT 'aligned', family, aligned_from, aligned_to, count(*) FROM lines GROUP BY 2, 3, 4""",
)
def validity_window(spark, d):
    plain = sale_lines(spark, d, False).withColumnsRenamed({"business_from": "plain_from", "business_to": "plain_to"})
    annual, monthly = _families()
    sold, start, end = F.col("sold_on"), F.col("valid_from"), F.col("valid_to")
    variants = F.array(
        F.struct(F.lit("plain").alias("variant"), F.col("plain_from").alias("business_from"), F.col("plain_to").alias("business_to")),
        F.struct(
            F.lit("aligned").alias("variant"),
            validity_start(sold, start, annual, True).alias("business_from"),
            validity_end(sold, start, end, annual, monthly, True).alias("business_to"),
        ),
    )
    return plain.select("family", F.explode(variants).alias("v")).groupBy(
        "family", "v.variant", "v.business_from", "v.business_to"
    ).agg(F.count(F.lit(1)).alias("lines"))


@query(
    "business_prices",
    f"""WITH {SALE_LINES}
    SELECT family, account, CAST(sum(CAST(business_price AS DECIMAL(18,6))) AS DECIMAL(28,6)) AS price,
      CAST(sum(CAST(business_price * 100 / (100 + vat_rate) AS DECIMAL(18,6))) AS DECIMAL(28,6)) AS price_net, CAST(sum(trips) AS BIGINT) AS trips
    FROM lines GROUP BY 1, 2""",
)
def business_prices(spark, d):
    return sale_lines(spark, d, False).groupBy("family", "account").agg(
        F.sum(F.col("business_price").cast("decimal(18,6)")).alias("price"),
        F.sum(F.col("business_price_net").cast("decimal(18,6)")).alias("price_net"),
        F.sum("trips").alias("trips"),
    )


@query(
    "revenue_by_account",
    f"""WITH {SALE_LINES},
    t AS (SELECT account, CAST(sum(trips) AS BIGINT) AS trips, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS amount
      FROM lines WHERE plain_from >= DATE '1997-03-01' AND plain_to < DATE '1997-04-01' GROUP BY 1)
    SELECT a.account, trips, amount, round(CAST(amount AS DOUBLE) * 100 / 110, 4) AS amount_net
    FROM (SELECT DISTINCT p_brand AS account FROM part) a LEFT JOIN t USING (account)""",
)
def revenue_by_account(spark, d):
    from datetime import date

    out = revenue.revenue_by_account(
        accounts(spark, d), sale_lines(spark, d, False), date(1997, 3, 1), date(1997, 4, 1)
    )
    return out.withColumn("amount_net", F.round("amount_net", 4))


@query(
    "active_at_boundary",
    f"""WITH {SALE_LINES},
    t AS (SELECT account, CAST(sum(trips) AS BIGINT) AS trips, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS amount
      FROM lines WHERE (aligned_from < DATE '1997-03-01' AND aligned_to > DATE '1997-03-01')
        OR (aligned_from < DATE '1997-04-01' AND aligned_to > DATE '1997-04-01') GROUP BY 1)
    SELECT a.account, trips, amount, round(CAST(amount AS DOUBLE) * 100 / 110, 4) AS amount_net
    FROM (SELECT DISTINCT p_brand AS account FROM part) a LEFT JOIN t USING (account)""",
)
def active_at_boundary(spark, d):
    from datetime import date

    out = revenue.active_at_boundaries(
        accounts(spark, d), sale_lines(spark, d, True), [date(1997, 3, 1), date(1997, 4, 1)]
    )
    return out.withColumn("amount_net", F.round("amount_net", 4))


@query(
    "monthly_sales",
    f"""WITH {SALE_LINES}
    SELECT year(sold_on) AS year, month(sold_on) AS month, family, account, CAST(sum(quantity) AS BIGINT) AS quantity,
      CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS amount
    FROM lines GROUP BY 1, 2, 3, 4""",
)
def monthly_sales(spark, d):
    lines = sales(spark, d).join(products(spark, d), "product", "left")
    return revenue.sales_by_period(lines, "sold_on", ["family", "account"])


@query(
    "validations_by_stop",
    """SELECT CAST(l_shipdate AS DATE) AS day, s_name AS stop_name, n_name AS area, count(*) AS validations
    FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey
    WHERE l_returnflag IN ('A', 'R') AND n_name IS NOT NULL GROUP BY 1, 2, 3""",
)
def validations_by_stop(spark, d):
    dims = [(table(spark, d, "supplier"), "l_suppkey", "s_suppkey"), (table(spark, d, "nation"), "s_nationkey", "n_nationkey")]
    accepted = F.col("l_returnflag").isin("A", "R") & F.col("n_name").isNotNull()
    keys = {"day": F.col("l_shipdate").cast("date"), "stop_name": F.col("s_name"), "area": F.col("n_name")}
    return ticketing.validations_by(table(spark, d, "lineitem"), dims, accepted, keys)


@query(
    "daily_distinct",
    """SELECT CAST(ts AS DATE) AS day, count(*) AS validations, count(DISTINCT user_id) AS cards FROM events GROUP BY 1""",
)
def daily_distinct(spark, d):
    return ticketing.daily_counts(table(spark, d, "events"), F.col("ts").cast("date"), "user_id")


@query(
    "yearly_validations",
    """SELECT year(o_orderdate) AS year, CAST(count(*) AS BIGINT) AS validations FROM orders GROUP BY 1""",
)
def yearly_validations(spark, d):
    from lakeops.operators.panel import day_bounds
    from lakeops.plans.calendar import calendar_dimension

    orders = table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    return ticketing.yearly(orders, calendar_dimension(day_bounds(orders, F.col("day"))).select("day", "year"), "day")


@query(
    "validation_detail",
    """SELECT event_id, CAST(ts - INTERVAL 4 HOUR AS DATE) AS operating_day,
      CASE event_type WHEN 'purchase' THEN 'card' WHEN 'signup' THEN 'ticket' ELSE 'other' END AS support,
      CASE WHEN user_id % 2 = 0 THEN 'outbound' ELSE 'inbound' END AS direction, n_name AS stop_name
    FROM events LEFT JOIN nation ON user_id % 25 = n_nationkey""",
)
def validation_detail(spark, d):
    nation = table(spark, d, "nation")
    rows = table(spark, d, "events").withColumn("stop", F.col("user_id") % 25)
    rows = ticketing.star(rows, [(nation, "stop", "n_nationkey")])
    codes = {
        "support": coding.code_map(F.col("event_type"), {"purchase": "card", "signup": "ticket"}, "other"),
        "direction": F.when(F.col("user_id") % 2 == 0, "outbound").otherwise("inbound"),
    }
    return ticketing.validation_detail(rows, "ts", codes).select(
        "event_id", "operating_day", "support", "direction", F.col("n_name").alias("stop_name")
    )


@query(
    "incident_log",
    """WITH e AS (SELECT *, CAST(ts - INTERVAL 4 HOUR AS DATE) AS service_day, CAST(round(value * 600) AS BIGINT) AS sec FROM events)
    SELECT event_id, n_name, r_name, split_part(event_type || '/' || CAST(user_id AS VARCHAR), '/', 1) AS line_number,
      lpad(CAST(hour(ts) + 24 * date_diff('day', service_day, CAST(ts AS DATE)) AS VARCHAR), 2, '0') || ':' || lpad(CAST(minute(ts) AS VARCHAR), 2, '0') AS start_clock,
      lpad(CAST(hour(ts + to_seconds(sec)) + 24 * date_diff('day', service_day, CAST(ts + to_seconds(sec) AS DATE)) AS VARCHAR),
        CASE WHEN hour(ts + to_seconds(sec)) + 24 * date_diff('day', service_day, CAST(ts + to_seconds(sec) AS DATE)) > 99 THEN 3 ELSE 2 END, '0')
        || ':' || lpad(CAST(minute(ts + to_seconds(sec)) AS VARCHAR), 2, '0') AS end_clock,
      lpad(CAST(sec % 86400 // 3600 AS VARCHAR), 2, '0') || ':' || lpad(CAST(sec % 3600 // 60 AS VARCHAR), 2, '0') AS duration,
      round(sec / 60, 6) AS duration_min
    FROM e JOIN nation ON user_id % 25 = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def incident_log(spark, d):
    start = F.col("ts").cast("timestamp")
    end = F.timestamp_micros(F.unix_micros(start) + F.round(F.col("value") * 600).cast("long") * 1_000_000)
    rows = table(spark, d, "events").select(
        "event_id",
        F.col("ts").alias("started_at"),
        end.cast("timestamp_ntz").alias("ended_at"),
        clock.operating_day(F.col("ts")).alias("service_day"),
        (F.col("user_id") % 25).alias("reason_id"),
        F.concat_ws("/", "event_type", F.col("user_id").cast("string")).alias("line"),
    )
    dims = [
        (table(spark, d, "nation"), "reason_id", "n_nationkey"),
        (table(spark, d, "region"), "n_regionkey", "r_regionkey"),
    ]
    return incidents.incident_log(rows, dims, F.col("line")).select(
        "event_id", "n_name", "r_name", "line_number", "start_clock", "end_clock", "duration",
        F.round("duration_min", 6).alias("duration_min"),
    )


@query(
    "instalment_export",
    """WITH contacts AS (SELECT o_custkey AS customer_id, o_orderkey AS contact_id, o_orderpriority AS address, o_orderstatus = 'P' AS deleted FROM orders),
    live AS (SELECT * FROM contacts WHERE NOT deleted),
    f AS (SELECT customer_id, first(address ORDER BY contact_id) AS first_address,
            string_agg(DISTINCT address, ';' ORDER BY address) AS addresses FROM live GROUP BY 1),
    i AS (SELECT l_orderkey AS plan_id, count(*) AS n, count(*) FILTER (WHERE l_linestatus = 'F') AS paid FROM lineitem GROUP BY 1)
    SELECT o_orderkey AS plan_id, o_custkey AS customer_id, c_name, first_address, addresses,
      coalesce(n, 0) AS instalments, coalesce(paid, 0) AS paid
    FROM orders LEFT JOIN i ON plan_id = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN f ON f.customer_id = o_custkey""",
)
def instalment_export(spark, d):
    orders = table(spark, d, "orders")
    contacts = orders.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").alias("contact_id"),
        F.col("o_orderpriority").alias("address"),
        (F.col("o_orderstatus") == "P").alias("deleted"),
    )
    plans = orders.select(F.col("o_orderkey").alias("plan_id"), F.col("o_custkey").alias("customer_id"))
    instalments = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("plan_id"), F.when(F.col("l_linestatus") == "F", "paid").otherwise("due").alias("status")
    )
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("customer_id"), "c_name")
    return revenue.instalment_export(customers, contacts, instalments, plans)


@query(
    "rate_by_group",
    """SELECT l_returnflag, round(CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 9) AS open_rate
    FROM lineitem GROUP BY 1""",
)
def rate_by_group(spark, d):
    opened = coding.flag(F.col("l_linestatus") == "O")
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.round(summaries.rate(opened, F.lit(1)), 9).alias("open_rate")
    )
