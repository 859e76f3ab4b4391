"""Entity-day marts, rates, factor screening and tree rules."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from lakeops.functions.coding import flag
from lakeops.operators import lookback as look, screening
from lakeops.plans import attendance
from lakeops.registry.base import TYPES, PANEL, money, panel, query, table
from lakeops.registry.timelines import ISLANDS


def _week_off():
    return F.weekday("day") >= 5


@query(
    "time_profile",
    f"""WITH {PANEL}, c AS (SELECT a.entity, a.day, count(*) FILTER (WHERE b.n_events = 1) AS quiet, count(*) FILTER (WHERE b.n_events BETWEEN 2 AND 3) AS usual,
      count(*) FILTER (WHERE b.n_events > 3) AS busy, count(*) FILTER (WHERE b.flag = 1) AS flagged, count(*) FILTER (WHERE b.flag = 0) AS clear
      FROM panel a LEFT JOIN panel b ON a.entity = b.entity AND b.day >= CAST(a.day - INTERVAL 3 MONTH AS DATE) AND b.day < a.day GROUP BY 1, 2)
    SELECT entity, day, quiet, usual, busy, CASE WHEN quiet + usual + busy > 0 THEN round(CAST(busy AS DOUBLE) / (quiet + usual + busy), 9) END AS part_busy,
      CASE WHEN flagged + clear > 0 THEN round(CAST(flagged AS DOUBLE) / (flagged + clear), 9) END AS part_flagged,
      CASE WHEN quiet + usual + busy > 0 AND CAST(busy AS DOUBLE) / (quiet + usual + busy) > 0.25 THEN 1 ELSE 0 END AS mostly_busy FROM c""",
)
def time_profile(spark, d):
    n = F.col("n_events")
    categories = {
        "load": {"quiet": n == 1, "usual": n.between(2, 3), "busy": n > 3},
        "state": {"flagged": F.col("flag") == 1, "clear": F.col("flag") == 0},
    }
    out = attendance.time_profile(panel(spark, d), categories, {"mostly_busy": ("part_busy", 0.25)})
    return out.select(
        "entity", "day", "quiet", "usual", "busy", F.round("part_busy", 9).alias("part_busy"),
        F.round("part_flagged", 9).alias("part_flagged"), "mostly_busy",
    )


def typology_sql(count, days):
    return (
        f"CASE WHEN {count} <= 0 AND {days} >= 0 THEN 'none' WHEN {count} <= 2 AND {days} BETWEEN 0 AND 4 THEN 'few short' "
        f"WHEN {count} <= 2 AND {days} > 4 THEN 'few long' WHEN {count} <= 6 AND {days} >= 0 THEN 'some' ELSE 'many' END"
    )


@query(
    "frequency_typology",
    f"""WITH {ISLANDS}, f AS (SELECT a.entity, a.day, count(DISTINCT b.episode) FILTER (WHERE b.flag = 1) AS episodes, CAST(coalesce(sum(b.flag), 0) AS BIGINT) AS flagged_days
      FROM islands a LEFT JOIN islands b ON a.entity = b.entity AND b.day > CAST(a.day - INTERVAL 3 MONTH AS DATE) AND b.day <= a.day GROUP BY 1, 2),
    m AS (SELECT *, last_value(episodes) OVER w AS me, last_value(flagged_days) OVER w AS mf FROM f
      WINDOW w AS (PARTITION BY entity, date_trunc('month', day) ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
    SELECT entity, day, episodes, flagged_days, {typology_sql('me', 'mf')} AS typology FROM m""",
)
def frequency_typology(spark, d):
    rows = attendance.episodes(attendance.bridge_off_days(panel(spark, d), _week_off()))
    return attendance.frequency_typology(rows, TYPES, "many").select("entity", "day", "episodes", "flagged_days", "typology")


@query(
    "episode_table",
    f"""WITH {ISLANDS} SELECT entity, episode, kind, length_class, min(day) AS first_day, max(day) AS last_day, count(*) AS days FROM measured WHERE flag = 1 GROUP BY 1, 2, 3, 4""",
)
def episode_table(spark, d):
    rows = attendance.episode_panel(panel(spark, d), _week_off()).filter(F.col("flag") == 1)
    return rows.groupBy("entity", "episode", "kind", "length_class").agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count(F.lit(1)).alias("days")
    )


CAUSES = {"errors": ["error"], "web": ["click", "view"], "all": ["error", "click", "view", "purchase", "signup"]}
ORDER_PANEL = """p AS (SELECT CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS flag, o_orderpriority AS kind,
  CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders)"""
ORDER_CAUSES = {"urgent": ["1-URGENT"], "high": ["1-URGENT", "2-HIGH"]}
RATES = f"""{ORDER_PANEL},
m AS (SELECT year(day) AS year, month(day) AS month, cause, sum(CASE WHEN flag = 1 AND kind = ANY(kinds) THEN amount ELSE 0 END) AS flagged,
  sum(CASE WHEN flag = 0 THEN amount WHEN kind = ANY(kinds) THEN amount ELSE 0 END) AS total
  FROM p, (VALUES ('urgent', ['1-URGENT']), ('high', ['1-URGENT', '2-HIGH'])) v(cause, kinds) GROUP BY 1, 2, 3),
r AS (SELECT year, month, cause, CASE WHEN total > 0 THEN CAST(flagged AS DOUBLE) / CAST(total AS DOUBLE) END AS a,
  CASE WHEN sum(total) OVER w > 0 THEN CAST(sum(flagged) OVER w AS DOUBLE) / CAST(sum(total) OVER w AS DOUBLE) END AS b,
  CASE WHEN sum(total) OVER y > 0 THEN CAST(sum(flagged) OVER y AS DOUBLE) / CAST(sum(total) OVER y AS DOUBLE) END AS c FROM m
  WINDOW w AS (PARTITION BY cause ORDER BY year, month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW), y AS (PARTITION BY cause, year ORDER BY month ROWS UNBOUNDED PRECEDING))"""


def _rates(spark, d):
    rows = table(spark, d, "orders").select(
        F.col("o_orderdate").cast("date").alias("day"),
        F.when(F.col("o_orderstatus") == "F", 0).otherwise(1).alias("flag"),
        F.col("o_orderpriority").alias("kind"),
        money("o_totalprice").alias("amount"),
    )
    return attendance.monthly_rates(rows, "amount", ORDER_CAUSES)


@query(
    "monthly_rates",
    f"""WITH {RATES} SELECT year, month, cause, round(a, 9) AS rate_month, round(b, 9) AS rate_12_months, round(c, 9) AS rate_year_to_date FROM r""",
)
def monthly_rates(spark, d):
    out = _rates(spark, d)
    return out.select("year", "month", "cause", *[F.round(c, 9).alias(c) for c in ("rate_month", "rate_12_months", "rate_year_to_date")])


@query(
    "long_rates",
    f"""WITH {RATES} SELECT year, month, cause, unnest(['rate_month', 'rate_12_months', 'rate_year_to_date']) AS variable, round(unnest([a, b, c]), 9) AS value FROM r""",
)
def long_rates(spark, d):
    return attendance.long_rates(_rates(spark, d)).withColumn("value", F.round("value", 9))


@query(
    "bonus_lookback",
    """WITH l AS (SELECT o_custkey AS entity, CAST(o_orderdate AS DATE) AS day, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS amount,
      CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS BIGINT) AS urgent FROM orders GROUP BY 1, 2)
    SELECT a.entity, a.day, CAST(coalesce(sum(b.amount), 0) AS DECIMAL(28,2)) AS amount_before, CAST(coalesce(sum(b.urgent), 0) AS BIGINT) AS urgent_before, count(b.day) AS days_seen
    FROM l a LEFT JOIN l b ON a.entity = b.entity AND b.day > CAST(a.day - INTERVAL 10 MONTH AS DATE) AND b.day <= a.day GROUP BY 1, 2""",
)
def bonus_lookback(spark, d):
    rows = table(spark, d, "orders").select(
        F.col("o_custkey").alias("entity"), F.col("o_orderdate").cast("date").alias("day"), "o_totalprice", "o_orderpriority"
    )
    days = look.daily(
        rows, "entity", "day", {"amount": money("o_totalprice"), "urgent": flag(F.col("o_orderpriority") == "1-URGENT")}
    )
    out = look.lookback(
        days, "entity", "day", 10, {"amount_before": "amount", "urgent_before": "urgent"}, include_today=True, include_edge=False
    )
    return out.select("entity", "day", "amount_before", "urgent_before", "days_seen")


@query(
    "tenure_features",
    """WITH t AS (SELECT o_custkey AS entity, min(CAST(o_orderdate AS DATE)) AS hired, max(CAST(o_orderdate AS DATE)) AS seen, count(*) AS orders FROM orders GROUP BY 1)
    SELECT entity, date_diff('day', hired, seen) AS tenure_days, CASE WHEN date_diff('day', hired, seen) <= 365 THEN 'first year' WHEN date_diff('day', hired, seen) <= 1825 THEN 'up to 5 years' ELSE 'longer' END AS tenure_band,
      trim(c_mktsegment) AS segment, orders FROM t JOIN customer ON c_custkey = entity""",
)
def tenure_features(spark, d):
    from lakeops.functions.coding import band

    day = F.col("o_orderdate").cast("date")
    spans = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("entity")).agg(
        F.min(day).alias("hired"), F.max(day).alias("seen"), F.count(F.lit(1)).alias("orders")
    )
    people = table(spark, d, "customer").select(F.col("c_custkey").alias("entity"), F.trim("c_mktsegment").alias("segment"))
    tenure = F.datediff("seen", "hired")
    return spans.join(people, "entity").select(
        "entity", tenure.alias("tenure_days"),
        band(tenure, [(365, "first year"), (1825, "up to 5 years")], "longer").alias("tenure_band"), "segment", "orders",
    )


@query(
    "level_bands",
    """WITH q AS (SELECT o_orderpriority AS grade, quantile_disc(o_totalprice, 0.3) AS low, quantile_disc(o_totalprice, 0.7) AS high FROM orders GROUP BY 1)
    SELECT o_orderkey, CASE WHEN o_totalprice < low THEN 'low' WHEN o_totalprice >= high THEN 'high' ELSE 'middle' END AS level FROM orders JOIN q ON o_orderpriority = grade""",
)
def level_bands(spark, d):
    from lakeops.functions.coding import first_rule
    from lakeops.operators.summaries import exact_quantiles

    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    bounds = exact_quantiles(orders, "o_totalprice", {"low": "0.3", "high": "0.7"}, ["o_orderpriority"])
    price = F.col("o_totalprice")
    level = first_rule([(price < F.col("low"), "low"), (price >= F.col("high"), "high")], "middle")
    return orders.join(bounds, "o_orderpriority").select("o_orderkey", level.alias("level"))


FACTORS = ["weekend", "high_value", "many_events", "late_month"]


def factor_rows(spark, d):
    rows = panel(spark, d)
    return rows.select(
        "entity",
        "day",
        "flag",
        F.when(F.col("n_events") <= 2, "short").otherwise("long").alias("class"),
        flag(F.weekday("day") >= 5).alias("weekend"),
        flag(F.col("amount") > 100).alias("high_value"),
        flag(F.col("n_events") > 3).alias("many_events"),
        flag(F.dayofmonth("day") > 15).alias("late_month"),
    )


CHI2 = f"""{PANEL}, r AS (SELECT flag, CASE WHEN n_events <= 2 THEN 'short' ELSE 'long' END AS class, CASE WHEN isodow(day) >= 6 THEN 1 ELSE 0 END AS weekend,
  CASE WHEN amount > 100 THEN 1 ELSE 0 END AS high_value, CASE WHEN n_events > 3 THEN 1 ELSE 0 END AS many_events, CASE WHEN day(day) > 15 THEN 1 ELSE 0 END AS late_month FROM panel),
long AS (SELECT flag, class, unnest(['weekend', 'high_value', 'many_events', 'late_month']) AS factor, unnest([weekend, high_value, many_events, late_month]) AS v FROM r),
base AS (SELECT factor, count(*) FILTER (WHERE v = 0) AS base_0, count(*) FILTER (WHERE v = 1) AS base_1 FROM long WHERE flag = 0 GROUP BY 1),
target AS (SELECT factor, class, count(*) FILTER (WHERE v = 0) AS target_0, count(*) FILTER (WHERE v = 1) AS target_1 FROM long WHERE flag = 1 GROUP BY 1, 2),
cells AS (SELECT *, CAST(base_0 AS DOUBLE) AS a, CAST(target_0 AS DOUBLE) AS b, CAST(base_1 AS DOUBLE) AS c, CAST(target_1 AS DOUBLE) AS d FROM base JOIN target USING (factor)
  WHERE target_0 >= 20 AND target_1 >= 20 AND base_0 > 0 AND base_1 > 0),
tested AS (SELECT *, (a + b + c + d) * (a * d - b * c) * (a * d - b * c) / ((a + b) * (c + d) * (a + c) * (b + d)) AS chi2, CASE WHEN b / a <= d / c THEN 1 ELSE -1 END AS sign FROM cells),
screen AS (SELECT factor, class, base_0, base_1, target_0, target_1, chi2,
  sign * CASE WHEN chi2 >= 6.6348966 THEN 3 WHEN chi2 >= 3.8414588 THEN 2 WHEN chi2 >= 2.7055435 THEN 1 ELSE 0 END AS score FROM tested)"""


@query(
    "chi2_screen",
    f"""WITH {CHI2} SELECT factor, class, base_0, base_1, target_0, target_1, round(chi2, 6) AS chi2, score,
      CASE WHEN score = 0 THEN '==' WHEN score > 0 THEN repeat('+', score) ELSE repeat('-', -score) END AS verdict FROM screen""",
)
def chi2_screen(spark, d):
    out = screening.chi2_screen(factor_rows(spark, d), FACTORS, "flag", "class", ["short", "long"])
    return out.withColumn("chi2", F.round("chi2", 6))


@query("factor_scores", f"WITH {CHI2} SELECT factor, CAST(sum(score) AS BIGINT) AS score FROM screen GROUP BY 1")
def factor_scores(spark, d):
    return screening.factor_scores(screening.chi2_screen(factor_rows(spark, d), FACTORS, "flag", "class", ["short", "long"]))


def tree_sql(depth: int, min_leaf: int) -> str:
    """A tree on the factors, grown level by level: each node is cut by the factor with the largest Gini decrease, if both
    sides have enough rows; nodes whose leaves all say the same are leaves. ``leaves`` and ``inner`` are its nodes."""
    gini = lambda n, p: f"(1 - ({p} / {n}) * ({p} / {n}) - (1 - {p} / {n}) * (1 - {p} / {n}))"
    parts = [f"""{PANEL}, r AS (SELECT flag, CASE WHEN isodow(day) >= 6 THEN 1 ELSE 0 END AS weekend, CASE WHEN amount > 100 THEN 1 ELSE 0 END AS high_value,
      CASE WHEN n_events > 3 THEN 1 ELSE 0 END AS many_events, CASE WHEN day(day) > 15 THEN 1 ELSE 0 END AS late_month FROM panel),
    m0 AS (SELECT '' AS path, CAST([] AS VARCHAR[]) AS factors, [weekend, high_value, many_events, late_month] AS v, CAST(count(*) AS DOUBLE) AS n, CAST(sum(flag) AS DOUBLE) AS p FROM r GROUP BY 3)"""]
    for k in range(depth):
        parts.append(f"""c{k} AS (SELECT path, i, sum(n) AS n, sum(p) AS p, sum(n) FILTER (v[i] = 0) AS n0, sum(p) FILTER (v[i] = 0) AS p0, sum(n) FILTER (v[i] = 1) AS n1, sum(p) FILTER (v[i] = 1) AS p1
      FROM m{k}, range(1, 5) t(i) GROUP BY 1, 2),
    g{k} AS (SELECT *, {gini('n', 'p')} - n0 / n * {gini('n0', 'p0')} - n1 / n * {gini('n1', 'p1')} AS gain FROM c{k} WHERE n0 >= {min_leaf} AND n1 >= {min_leaf}),
    b{k} AS (SELECT * FROM g{k} WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY path ORDER BY gain DESC, i) = 1),
    m{k + 1} AS (SELECT m.path || CASE WHEN v[b.i] = 1 THEN 'R' ELSE 'L' END AS path, list_append(factors, ['weekend', 'high_value', 'many_events', 'late_month'][b.i]) AS factors, v, m.n, m.p
      FROM m{k} m JOIN b{k} b ON b.path = m.path)""")
    nodes = " UNION ALL ".join(f"SELECT path, any_value(factors) AS factors, sum(n) AS n, sum(p) AS p FROM m{k} GROUP BY 1" for k in range(depth + 1))
    cuts = " UNION ALL ".join(f"SELECT path, i, gain FROM b{k}" for k in range(depth))
    # A node stays cut if some leaf below it says something else than another one.
    parts.append(f"""nodes AS (SELECT *, CASE WHEN p > n - p THEN 1 ELSE 0 END AS said FROM ({nodes})), cuts AS ({cuts}),
    ends AS (SELECT * FROM nodes WHERE path NOT IN (SELECT path FROM cuts)),
    inner_ AS (SELECT c.path, c.i, c.gain, max(n.n) AS n FROM cuts c JOIN nodes n ON n.path = c.path JOIN ends e ON starts_with(e.path, c.path) GROUP BY 1, 2, 3 HAVING count(DISTINCT e.said) > 1),
    leaves AS (SELECT *, CAST(row_number() OVER (ORDER BY path) - 1 AS INTEGER) AS leaf FROM nodes
      WHERE path NOT IN (SELECT path FROM inner_) AND (path = '' OR left(path, length(path) - 1) IN (SELECT path FROM inner_)))""")
    return ",\n".join(parts)


TREE = tree_sql(4, 20)


def _tree(spark, d):
    rows = factor_rows(spark, d).drop("class")
    return screening.fit_tree(rows, FACTORS, "flag", 20, depth=4)


@query(
    "tree_leaf_stats",
    f"""WITH {TREE} SELECT leaf, CAST(n AS BIGINT) AS rows, said AS predicted, CAST(CASE WHEN said = 1 THEN p ELSE n - p END AS BIGINT) AS correct,
      CAST(CASE WHEN said = 1 THEN n - p ELSE p END AS BIGINT) AS wrong, CAST(p AS BIGINT) AS positives, round(CASE WHEN said = 1 THEN p ELSE n - p END / n, 9) AS precision, round(p / n, 9) AS rate FROM leaves""",
)
def tree_leaf_stats(spark, d):
    return screening.leaf_stats(_tree(spark, d)[1], "flag").withColumns({c: F.round(c, 9) for c in ("precision", "rate")})


@query(
    "tree_top_leaf_rules",
    f"""WITH {TREE}, top AS (SELECT * FROM leaves WHERE n >= 50 ORDER BY p / n DESC, leaf LIMIT 15)
    SELECT leaf, CAST(step - 1 AS INTEGER) AS step, factors[step] AS factor, substr(path, step, 1) = 'R' AS holds, CAST(n AS BIGINT) AS rows, round(p / n, 9) AS rate
    FROM (SELECT *, unnest(range(1, length(path) + 1)) AS step FROM top)""",
)
def tree_top_leaf_rules(spark, d):
    model, scored = _tree(spark, d)
    best = screening.top_leaves(screening.leaf_stats(scored, "flag"), at_least=50)
    return screening.leaf_rules(model, scored, FACTORS).join(best.select("leaf", "rows", F.round("rate", 9).alias("rate")), "leaf")


@query(
    "tree_rules_cover",
    f"""WITH {PANEL} SELECT count(*) AS rows, count(*) AS by_rules, CAST(sum(flag) AS BIGINT) AS positives, CAST(0 AS BIGINT) AS elsewhere, count(*) AS correct_or_wrong FROM panel""",
)
def tree_rules_cover(spark, d):
    """Every row meets the rules of one leaf, and it is the leaf the model puts it in."""
    model, scored = _tree(spark, d)
    rules = screening.leaf_rules(model, scored, FACTORS)
    values = F.create_map(*[x for f in FACTORS for x in (F.lit(f), F.col(f))])
    # Rows with equal factors meet the same rules, so combinations are tested in place of rows.
    kinds = scored.groupBy(*FACTORS, F.col("leaf").alias("given")).agg(F.count(F.lit(1)).alias("n")).withColumn("value", values)
    steps = rules.select("leaf", "holds", F.col("factor").alias("rule")).withColumn("needed", F.count("rule").over(Window.partitionBy("leaf")))
    tested = kinds.select("given", "n", *FACTORS, F.explode("value").alias("rule", "v")).join(steps, "rule")
    met = tested.groupBy("given", "n", *FACTORS, "leaf", "needed").agg(F.count_if((F.col("v") == 1) == F.col("holds")).alias("met"))
    covered = met.filter("met = needed").agg(F.sum("n").alias("by_rules"), F.coalesce(F.sum(F.when(F.col("leaf") != F.col("given"), F.col("n"))), F.lit(0)).alias("elsewhere"))
    stats = screening.leaf_stats(scored, "flag").agg(
        F.sum("rows").alias("rows"), F.sum("positives").alias("positives"), F.sum(F.col("correct") + F.col("wrong")).alias("correct_or_wrong")
    )
    both = stats.unionByName(covered, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


@query(
    "factor_importance",
    f"""WITH {TREE}, f AS (SELECT ['weekend', 'high_value', 'many_events', 'late_month'][i] AS factor, sum(gain * n) AS gained FROM inner_ GROUP BY 1),
    scored AS (WITH {CHI2} SELECT factor, sum(score) AS score FROM screen GROUP BY 1)
    SELECT CASE WHEN coalesce(score, 0) < 0 THEN 'not ' || f.factor ELSE f.factor END AS factor, round(gained / sum(gained) OVER (), 9) AS importance
    FROM f LEFT JOIN scored s ON s.factor = f.factor""",
)
def factor_importance(spark, d):
    model, scored = _tree(spark, d)
    scores = factor_scores(spark, d)
    signed = screening.signed_importance(screening.importance(model, scored, FACTORS), scores)
    return signed.withColumn("importance", F.round("importance", 9))
