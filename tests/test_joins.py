import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakeops.operators import joins, lookback as look, panel

TS = "timestamp_ntz"


def at(minutes):
    return dt.datetime(2024, 1, 1, 12) + dt.timedelta(minutes=minutes)


BANDS = [("a", 0, 10), ("b", 10, 20), ("c", 30, 40), ("upside down", 50, 45)]
FACTS = [(1, 0), (2, 10), (3, 20), (4, 25), (5, None), (6, 40), (7, 47)]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_band_edges(spark, how):
    facts = spark.createDataFrame(FACTS, "id int, v int")
    bands = spark.createDataFrame(BANDS, "band string, lo int, hi int")
    got = sorted((r["id"], r["band"] or "") for r in joins.band_join(facts, bands, F.col("v"), "lo", "hi", how).collect())
    found = [(1, "a"), (2, "a"), (2, "b"), (3, "b"), (6, "c")]
    assert got == sorted(found + [(4, ""), (5, ""), (7, "")] * (how == "left"))


def test_bands_of_any_length_explode_little(spark):
    r = random.Random(8)
    spans = [(i, lo, lo + r.choice([0, 0.25, 1, 3, 1_000, 10_000_000])) for i in range(60) for lo in [r.uniform(-1e6, 1e6)]]
    points = [(i, r.choice([r.uniform(-1e6, 1e6), *(s[r.choice([1, 2])] for s in spans[:5])])) for i in range(80)]
    bands = spark.createDataFrame(spans, "band int, lo double, hi double")
    facts = spark.createDataFrame(points + [(100, None)], "id int, v double")
    joined = joins.band_join(facts, bands, F.col("v"), "lo", "hi")
    got = sorted((x["id"], -1 if x["band"] is None else x["band"]) for x in joined.collect())
    want = [(i, b) for i, v in points for b, lo, hi in spans if lo <= v <= hi]
    assert got == sorted(want + [(i, -1) for i, _ in points + [(100, None)] if i not in {k for k, _ in want}])
    cells = joined._jdf.queryExecution().analyzed().toString()
    assert cells.count("Generate explode(__levels") >= 1
    # Two cells a band at most, whatever its length.
    wide = spark.createDataFrame([(1, 0.5, 1e15)], "band int, lo double, hi double")
    tall = joins.band_join(facts, wide, F.col("v"), "lo", "hi", "inner")
    assert {x["id"] for x in tall.collect()} == {i for i, v in points if 0.5 <= v <= 1e15}


def nearest(spark, subject_minutes, event_minutes, chunk_rows=3):
    subjects = spark.createDataFrame([("v", i, at(m)) for i, m in enumerate(subject_minutes)], f"k string, id int, t {TS}")
    events = spark.createDataFrame([("v", i, at(m)) for i, m in enumerate(event_minutes)], f"k string, eid int, e {TS}")
    out = joins.nearest_event(subjects, events, ["k"], "t", "e", ["e", "eid"], ["eid"], 120, 1200, chunk_rows=chunk_rows)
    return [r["eid"] for r in out.orderBy("id").collect()]


def test_nearest_bounds_are_open(spark):
    assert nearest(spark, [0], [-2]) == [None]
    assert nearest(spark, [0], [-1.99]) == [0]
    assert nearest(spark, [0], [20]) == [None]
    assert nearest(spark, [0], [19.99]) == [0]
    assert nearest(spark, [0], []) == [None]


def test_nearest_weighs_later_events(spark):
    assert nearest(spark, [0], [-1.5, 0.1]) == [1]
    assert nearest(spark, [0], [-0.9, 0.1]) == [0]
    assert nearest(spark, [0], [-1, 0.1]) == [0], "equal cost takes the earlier event"
    assert nearest(spark, [0], [0, 0]) == [0], "same instant takes the first id"


def test_nearest_against_brute_force(spark):
    r = random.Random(4)
    subjects = [(r.choice("ab"), i, at(r.randint(0, 3000) / 10)) for i in range(60)]
    events = [(r.choice("abc"), i, at(r.randint(0, 3000) / 10)) for i in range(40)]
    want = {}
    for k, i, t in subjects:
        best = None
        for ek, eid, e in events:
            gap = (t - e).total_seconds()
            if ek == k and -1200 < gap < 120:
                cost = (gap if gap >= 0 else -10 * gap, e, eid)
                best = min(best, cost) if best else cost
        want[i] = best[2] if best else None
    s = spark.createDataFrame(subjects, f"k string, id int, t {TS}")
    e = spark.createDataFrame(events, f"k string, eid int, e {TS}")
    out = joins.nearest_event(s, e, ["k"], "t", "e", ["e", "eid"], ["eid"], 120, 1200, chunk_rows=2)
    assert {r["id"]: r["eid"] for r in out.collect()} == want


def test_count_in_ranges_against_brute_force(spark):
    r = random.Random(8)
    spans = [(r.choice("ab"), i, at(a := r.randint(0, 200)), at(a + r.randint(0, 90))) for i in range(40)]
    points = [(r.choice("ab"), at(r.randint(0, 250))) for _ in range(80)]
    want = {i: sum(k == pk and lo <= p <= hi for pk, p in points) for k, i, lo, hi in spans}
    out = joins.count_in_ranges(
        spark.createDataFrame(spans, f"k string, id int, lo {TS}, hi {TS}"),
        spark.createDataFrame(points, f"k string, p {TS}"),
        ["k"], "id", "lo", "hi", "p", "n", chunk_rows=2,
    )
    assert {r["id"]: r["n"] for r in out.collect()} == want


def test_either_key_pairs_once(spark):
    left = spark.createDataFrame([(1,), (2,), (3,), (None,)], "a int")
    right = spark.createDataFrame([("x", 1, 1), ("y", 2, 9), ("z", None, 2)], "n string, b int, c int")
    out = joins.either_key_join(left, right, "a", ["b", "c"])
    assert sorted((r["a"] or 0, r["n"] or "") for r in out.collect()) == [(0, ""), (1, "x"), (2, "y"), (2, "z"), (3, "")]


def test_by_source(spark):
    left = spark.createDataFrame([("p", "1"), ("q", "1"), ("other", "1")], "source string, code string")
    right = spark.createDataFrame([("1", "9", "f1"), ("7", "1", "f2")], "ca string, cb string, fleet string")
    out = joins.by_source_join(left, right, "source", "code", {"p": "ca", "q": "cb"})
    assert {r["source"]: r["fleet"] for r in out.collect()} == {"p": "f1", "q": "f2", "other": None}


def test_latest_per_key_keeps_null_columns_and_columns_order(spark):
    df = spark.createDataFrame([(1, None, 5), (1, "x", 4), (2, "y", 1)], "k int, s string, o int")
    out = joins.latest_per_key(df, ["k"], ["o"])
    assert out.columns == ["k", "s", "o"]
    assert sorted(map(tuple, out.collect()), key=str) == [(1, None, 5), (2, "y", 1)]


def test_join_back_counts_null_keys_as_a_group(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,)], "k int")
    out = joins.join_back(df, ["k"], n=F.count(F.lit(1)))
    assert sorted((r["k"] or 0, r["n"]) for r in out.collect()) == [(0, 2), (0, 2), (1, 2), (1, 2)]


def day(text):
    return dt.date.fromisoformat(text)


def months_back(d, k):
    y, m = divmod(d.year * 12 + d.month - 1 - k, 12)
    last = (dt.date(y + (m == 11), (m + 1) % 12 + 1, 1) - dt.timedelta(1)).day
    return dt.date(y, m + 1, min(d.day, last))


@pytest.mark.parametrize("months,today,edge", [(3, False, True), (3, True, False), (1, False, True), (10, True, False), (3, True, True)])
def test_lookback_against_brute_force(spark, months, today, edge):
    r = random.Random(months)
    days = {day("2023-01-31") + dt.timedelta(r.randint(0, 420)) for _ in range(120)}
    days |= {day(d) for d in ("2023-02-28", "2023-05-31", "2023-11-30", "2024-02-29", "2023-03-31", "2023-12-31")}
    rows = [("e", d, i % 7) for i, d in enumerate(sorted(days))] + [("lonely", day("2023-01-31"), 4)]
    df = spark.createDataFrame(rows, "e string, d date, v int")
    out = look.lookback(df, "e", "d", months, {"s": "v"}, include_today=today, include_edge=edge)
    for row in out.collect():
        low = months_back(row["d"], months)
        inside = [v for e, d, v in rows if e == row["e"] and (low <= d if edge else low < d) and (d <= row["d"] if today else d < row["d"])]
        assert (row["s"], row["days_seen"]) == (sum(inside), len(inside)), row


def test_lookahead_and_distinct(spark):
    rows = [("e", day("2024-01-31"), 1, "x"), ("e", day("2024-02-10"), 1, "x"), ("e", day("2024-04-30"), 1, "y"), ("e", day("2024-05-01"), 1, None)]
    df = spark.createDataFrame(rows, "e string, d date, v int, c string")
    ahead = look.lookback(df, "e", "d", 3, {"s": "v"}, ahead=True, include_today=True, include_edge=False).orderBy("d").collect()
    assert [r["s"] for r in ahead] == [2, 3, 2, 1], "April 30 is the open end of January 31"
    kinds = look.distinct_in_lookback(df, "e", "d", 3, "c", "n").orderBy("d").collect()
    assert [r["n"] for r in kinds] == [1, 1, 2, 2]


def test_complete_panel(spark):
    df = spark.createDataFrame([("a", day("2024-02-27"), 1), ("a", day("2024-03-01"), 0), ("b", day("2024-01-01"), 1)], "e string, d date, f int")
    out = panel.complete_panel(df, "e", "d", {"f": 9}).orderBy("e", "d").collect()
    assert [(r["d"].isoformat(), r["f"], r["is_missing"]) for r in out] == [
        ("2024-02-27", 1, 0), ("2024-02-28", 9, 1), ("2024-02-29", 9, 1), ("2024-03-01", 0, 0), ("2024-01-01", 1, 0),
    ]


def test_rule_filter_and_counts(spark):
    df = spark.createDataFrame([("l", 1), ("l", 2), ("m", 1)], "line string, stop int")
    rules = spark.createDataFrame([("l", 1), ("l", 1)], "line string, stop int")
    assert joins.rule_filter(df, rules, ["line", "stop"]).count() == 1
    assert joins.rule_filter(df, rules, ["line", "stop"], exclude=True).count() == 2
    counted = joins.with_count(df, rules, ["line", "stop"], "n").orderBy("line", "stop").collect()
    assert [r["n"] for r in counted] == [2, 0, 0]
