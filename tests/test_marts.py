import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from lakeops.operators import screening
from lakeops.plans import attendance, calendar, revenue, service_quality as sq, ticketing, topology


def day(text):
    return dt.date.fromisoformat(text)


def passages(spark, rows):
    return spark.createDataFrame(rows, "line string, stop int, planned int, dev int, id int")


def test_headway_tolerances(spark):
    rows = passages(spark, [("l", 1, 0, 0, 1), ("l", 1, 600, 179, 2), ("l", 1, 1200, 359, 3), ("l", 1, 1300, -400, 4)])
    out = sq.headways(rows, ["line", "stop"], ["planned", "id"], "planned", "dev").orderBy("id").collect()
    assert [(r["planned_headway"], r["actual_headway"], r["regular"], r["counted"]) for r in out] == [
        (None, None, 0, 0), (600, 779, 1, 1), (600, 780, 0, 1), (100, -659, 0, 1),
    ]
    signed = sq.headways(rows, ["line", "stop"], ["planned", "id"], "planned", "dev", 180, absolute=False, inclusive=True)
    assert [r["regular"] for r in signed.orderBy("id").collect()] == [0, 1, 1, 1]
    rolled = sq.headway_rollup(sq.headways(rows, ["line", "stop"], ["planned", "id"], "planned", "dev"), ["line"]).first()
    assert (rolled["regular"], rolled["counted"]) == (1, 3) and abs(rolled["regularity"] - 1 / 3) < 1e-12


@pytest.mark.parametrize("dev,bus,terminus", [(-60, 0, 0), (-59, 1, 1), (0, 1, 1), (179, 1, 1), (180, 1, 0), (239, 1, 0), (240, 0, 0)])
def test_punctuality_bounds(spark, dev, bus, terminus):
    rows = spark.createDataFrame([("t", "c", s, s, dev) for s in range(3)], "trip string, chain string, stop int, o int, dev int")
    out = sq.punctuality(rows, ["trip"], ["o"], ["chain"], "stop", "dev").orderBy("o").collect()
    assert [r["on_time"] for r in out] == [bus] * 3
    assert [r["is_reference"] for r in out] == [1, 0, 0], "three stops less two"
    assert [r["on_time_reference"] for r in out] == [bus, 0, 0]
    first = sq.terminus_punctuality(rows, ["trip"], ["o"], "dev").collect()
    assert [(r["o"], r["on_time"]) for r in first] == [(0, terminus)]


@pytest.mark.parametrize("stops", [1, 2, 3, 5])
def test_chain_tail(spark, stops):
    points = spark.createDataFrame([("c", i, 10 + i) for i in range(stops)], "c string, o int, p int")
    out = sq.without_tail(points, ["c"], ["o"]).orderBy("o").collect()
    assert [r["rank"] for r in out] == list(range(1, stops - 1))


def test_topology(spark):
    points = spark.createDataFrame([("c", 1, 7), ("c", 2, 8), ("c", 3, 9)], "c string, o int, p int")
    legs = spark.createDataFrame([(7, 8, 100), (8, 9, 50), (9, 8, 1)], "from_point int, to_point int, distance int")
    out = topology.chain_topology(points, legs, ["c"], "o", "p", ["o"]).orderBy("o").collect()
    assert [(r["previous_point"], r["leg"], r["distance_so_far"], r["points_in_chain"], r["points_in_period"]) for r in out] == [
        (0, 0, 0, 3, 1), (7, 100, 100, 3, 1), (8, 50, 150, 3, 1),
    ]
    sized = spark.createDataFrame([("c", 1, 7, 3), ("c", 2, 8, 3), ("c", 3, 9, 3), ("d", 1, 7, 1)], "c string, o int, p int, n int")
    assert sorted(map(tuple, topology.termini(sized, ["c"], "p", "o", "n").collect())) == [("c", 7, 1), ("c", 9, 3), ("d", 7, 1)]


def test_episodes(spark):
    days = [("2024-01-05", 1, "m"), ("2024-01-06", 0, "m"), ("2024-01-07", 0, "m"), ("2024-01-08", 1, "m"), ("2024-01-10", 1, "m"),
            ("2024-01-11", 1, "x"), ("2024-01-12", 0, "x"), ("2024-01-13", 0, "x")]
    panel = spark.createDataFrame([("e", day(d), f, k) for d, f, k in days], "entity string, day date, flag int, kind string")
    out = attendance.episode_panel(panel, F.weekday("day") >= 5).orderBy("day").collect()
    assert [r["flag"] for r in out] == [1, 1, 1, 1, 1, 1, 0, 0], "the weekend between two flagged days is bridged"
    assert [r["episode"] for r in out] == [1, 1, 1, 1, 2, 3, 4, 5]
    assert [r["length_days"] for r in out] == [4, 4, 4, 4, 1, 1, 1, 1]
    assert [r["length_class"] for r in out][:5] == ["4 to 7 days"] * 4 + ["1 day"] and out[-1]["length_class"] == "none"
    assert [r["days_so_far"] for r in out][:4] == [1, 2, 3, 4] and {r["headcount"] for r in out} == {1}


def test_value_runs(spark):
    months = [("2023-01-01", 5), ("2023-02-01", 5), ("2023-03-01", 6), ("2023-10-01", 6), ("2026-01-01", 6)]
    series = spark.createDataFrame([("e", day(d), v) for d, v in months], "entity string, month date, v int")
    out = attendance.value_runs(series, "v", "month").orderBy("month").collect()
    assert [r["run"] for r in out] == [1, 1, 2, 2, 2]
    assert [r["days_unchanged"] for r in out] == [30, 61, 28, 242, 1065]
    assert [r["change_age"] for r in out] == ["recent", "recent", "recent", "between", "old"]


def test_monthly_rates_zero_base_and_windows(spark):
    rows = [("e", day("2023-12-05"), 1, "m", 4), ("e", day("2023-12-06"), 0, "m", 6), ("e", day("2024-01-05"), 0, "m", 0)]
    panel = spark.createDataFrame(rows, "entity string, day date, flag int, kind string, h int")
    out = attendance.monthly_rates(panel, "h", {"m": ["m"], "none": []}).filter("cause = 'm'").orderBy("year").collect()
    assert [(r["rate_month"], r["rate_12_months"], r["rate_year_to_date"]) for r in out] == [(0.4, 0.4, 0.4), (None, 0.4, None)]
    assert attendance.long_rates(attendance.monthly_rates(panel, "h", {"m": ["m"]})).count() == 6


def test_typology_takes_the_first_rule_that_holds(spark):
    rules = [(0, 0, None, "a"), (2, 1, 1, "b"), (2, 9, None, "c"), (2, 0, 4, "d"), (5, 0, None, "e")]
    cases = [(0, 0, "a"), (0, 7, "a"), (1, 1, "b"), (2, 9, "c"), (2, 30, "c"), (1, 0, "d"), (2, 4, "d"), (2, 5, "e"), (5, 1, "e"), (6, 1, "f")]
    df = spark.createDataFrame([(a, b) for a, b, _ in cases], "a int, b int")
    got = [r[0] for r in df.select(attendance.typology(F.col("a"), F.col("b"), rules, "f")).collect()]
    assert got == [c for _, _, c in cases]


def screen_rows(target_0, target_1, base_0, base_1):
    return [(0, 1, "c")] * target_0 + [(1, 1, "c")] * target_1 + [(0, 0, "none")] * base_0 + [(1, 0, "none")] * base_1


@pytest.mark.parametrize("cells,verdict", [
    ((19, 40, 100, 100), None), ((40, 40, 0, 100), None), ((40, 40, 100, 100), "=="), ((40, 52, 100, 90), "=="),
    ((40, 58, 100, 88), "++"), ((40, 55, 100, 90), "+"), ((30, 80, 100, 80), "+++"), ((80, 30, 80, 100), "---"), ((58, 40, 88, 100), "--"),
])
def test_chi2_verdicts(spark, cells, verdict):
    df = spark.createDataFrame(screen_rows(*cells), "f int, t int, k string")
    out = screening.chi2_screen(df, ["f"], "t", "k", ["c"]).collect()
    if verdict is None:
        assert out == []
        return
    t0, t1, b0, b1 = cells
    n = sum(cells)
    want = n * (b0 * t1 - t0 * b1) ** 2 / ((b0 + t0) * (b1 + t1) * (b0 + b1) * (t0 + t1))
    assert math.isclose(out[0]["chi2"], want) and out[0]["verdict"] == verdict, (out[0], want)


def test_chi2_weight_and_relabel(spark):
    df = spark.createDataFrame(screen_rows(30, 50, 90, 80), "f int, t int, k string").withColumn("w", F.lit(2))
    plain = screening.chi2_screen(df, ["f"], "t", "k", ["c"]).first()
    double = screening.chi2_screen(df, ["f"], "t", "k", ["c"], weight="w").first()
    turned = screening.chi2_screen(df.withColumn("f", 1 - F.col("f")), ["f"], "t", "k", ["c"]).first()
    assert math.isclose(double["chi2"], 2 * plain["chi2"])
    assert math.isclose(turned["chi2"], plain["chi2"]) and turned["score"] == -plain["score"]
    assert screening.factor_scores(screening.chi2_screen(df, ["f"], "t", "k", ["c"])).first()["score"] == plain["score"]


def test_tree_rules_lead_to_their_leaves(spark):
    r = random.Random(1)
    rows = []
    for _ in range(600):
        a, b, c = r.randint(0, 1), r.randint(0, 1), r.randint(0, 1)
        rows.append((a, b, c, int(r.random() < 0.1 + 0.6 * (a and b) + 0.2 * c)))
    df = spark.createDataFrame(rows, "a int, b int, c int, t int")
    factors = ["a", "b", "c"]
    model, scored = screening.fit_tree(df, factors, "t", 10, 3)
    rules = {}
    for x in screening.leaf_rules(model, df, factors).collect():
        rules.setdefault(x["leaf"], {})[x["factor"]] = x["holds"]
    for row in scored.select("a", "b", "c", "leaf").distinct().collect():
        assert all(bool(row[f]) == holds for f, holds in rules[row["leaf"]].items())
    stats = screening.leaf_stats(scored, "t")
    assert stats.agg(F.sum("rows")).first()[0] == 600
    best = screening.top_leaves(stats, 20, 3).collect()
    assert best == sorted(best, key=lambda s: -s["rate"]) and all(s["rows"] >= 20 for s in best)
    ranked = screening.importance(model, df, factors)
    assert all(x["importance"] > 0 for x in ranked.collect())
    scores = spark.createDataFrame([("a", -2), ("b", 3)], "factor string, score int")
    named = {x["factor"] for x in screening.signed_importance(ranked, scores).collect()}
    assert "not a" in named and "b" in named


def test_accounts_without_sales_stay(spark):
    accounts = spark.createDataFrame([("A",), ("B",)], "account string")
    products = spark.createDataFrame([("p", "A", "annual", 2)], "product string, account string, family string, trips_per_unit int")
    d = day("2021-10-10")
    sales = spark.createDataFrame([("p", d, None, None, 3, 24.0, 72.0, 10.0)],
                                  "product string, sold_on date, valid_from date, valid_to date, quantity int, price double, amount double, vat_rate double")
    lines = revenue.sale_lines(sales, products, F.col("family") == "annual", F.lit(False))
    row = lines.first()
    assert (row["trips"], row["business_price"], round(row["business_price_net"], 6)) == (6, 2.0, 1.818182)
    out = revenue.revenue_by_account(accounts, lines, day("2021-10-01"), day("2022-11-01")).orderBy("account").collect()
    assert out[0]["trips"] == 6 and round(out[0]["amount_net"], 4) == 65.4545 and out[1]["trips"] is None
    active = revenue.active_at_boundaries(accounts, lines, [day("2021-10-10"), day("2021-11-01")]).orderBy("account").collect()
    assert active[0]["trips"] == 6, "covers November 1; the sale day itself is not inside"


def test_boarding_needs_the_vehicle(spark):
    t = dt.datetime(2024, 1, 1, 12)
    validations = spark.createDataFrame([(1, t, "n", "1"), (2, t, "s", "1"), (3, t, "n", "404")], "id int, validated_at timestamp_ntz, source string, vehicle_code string")
    # The third validation knows no vehicle; the passage of an unknown vehicle is not its own.
    vehicles = spark.createDataFrame([("1", "2", "F1"), ("3", "1", "F2")], "ca string, cb string, fleet_code string")
    stops = spark.createDataFrame([("F1", t - dt.timedelta(seconds=30), 1, "X"), ("F2", t + dt.timedelta(minutes=5), 2, "Y"), (None, t, 3, "Z")],
                                  "fleet_code string, arrived_at timestamp_ntz, passage_id int, stop string")
    out = ticketing.boarding_stops(validations, vehicles, stops, {"n": "ca", "s": "cb"}, ["stop"])
    assert {r["id"]: (r["fleet_code"], r["stop"]) for r in out.collect()} == {1: ("F1", "X"), 2: ("F2", "Y"), 3: (None, None)}


def test_calendar_effects_and_pressure(spark):
    days = spark.createDataFrame([(day("2024-01-01") + dt.timedelta(i), int(i == 5), [1, 1, 9, 1, 1, 1, 1, 8, 1, 1][i]) for i in range(10)],
                                 "day date, holiday int, cases int")
    effects = calendar.calendar_effects(days, "holiday", {"hot": ("cases", "0.9")}, reach=1).orderBy("day").collect()
    assert [r["near_holiday"] for r in effects] == [0, 0, 0, 0, 1, 1, 1, 0, 0, 0]
    assert [r["hot"] for r in effects] == [0, 0, 1, 0, 0, 0, 0, 1, 0, 0] and [r["monday"] for r in effects][:8] == [1, 0, 0, 0, 0, 0, 0, 1]
    out = calendar.pressure_flags(days.select("day"), days.select("day", "cases"), {"cases": "c"}, "0.9").orderBy("day").collect()
    assert [r["c_peak_recent"] for r in out] == [0, 0, 0, 1, 1, 0, 0, 0, 1, 1] and [r["any_peak"] for r in out].count(1) == 2
