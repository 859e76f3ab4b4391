"""Periods against brute force over days, and marts on small cases."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakeops.operators import intervals
from lakeops.plans import people

START = dt.date(2024, 1, 1)
PERIOD = "k string, lo date, hi date, rank int, state string"


def day(n):
    return START + dt.timedelta(n)


def periods(seed, n=60):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        lo = r.randint(0, 120)
        rows.append((r.choice(["a", "a", "b", None]), day(lo), day(lo + r.choice([-1, 0, 1, 5, 30])), i, r.choice("xyz")))
    return rows + [("a", None, day(4), 1000, "x"), ("a", day(3), None, 1001, "x")]


def valid(rows):
    return [x for x in rows if x[0] is not None and x[1] and x[2] and x[1] <= x[2]]


def test_union_covers_the_same_days(spark):
    rows = periods(1)
    got = intervals.union(spark.createDataFrame(rows, PERIOD), ["k"], "lo", "hi", apart=1).collect()
    for key in ("a", "b"):
        own = sorted((x["lo"], x["hi"]) for x in got if x["k"] == key)
        covered = {d for _, lo, hi, *_ in valid([x for x in rows if x[0] == key]) for d in range((lo - START).days, (hi - START).days + 1)}
        assert {d for lo, hi in own for d in range((lo - START).days, (hi - START).days + 1)} == covered
        assert all((b[0] - a[1]).days > 1 for a, b in zip(own, own[1:]))


def test_one_state_a_day(spark):
    rows = [x for x in periods(2) if x[0] is not None]
    df = spark.createDataFrame(rows, PERIOD)
    one = intervals.one_state(df, ["k"], "lo", "hi", ["rank"], ["state"])
    got = one.collect()
    for key in ("a", "b"):
        own = valid([x for x in rows if x[0] == key])
        want = {}
        for n in range(200):
            held = [x for x in own if x[1] <= day(n) <= x[2]]
            if held:
                want[n] = max(held, key=lambda x: x[3])[4]
        pieces = sorted((x["lo"], x["hi"], x["state"]) for x in got if x["k"] == key)
        found = {(lo - START).days + i: s for lo, hi, s in pieces for i in range((hi - lo).days + 1)}
        assert found == want
        assert all(a[1] < b[0] for a, b in zip(pieces, pieces[1:]))
        assert all((b[0] - a[1]).days > 1 or a[2] != b[2] for a, b in zip(pieces, pieces[1:]))
    held_on = intervals.carried(one, ["k"], "lo", "hi", F.lit(day(300))).filter("k = 'a'").orderBy("lo").collect()
    assert all((b["lo"] - a["hi"]).days == 1 for a, b in zip(held_on, held_on[1:])) and held_on[-1]["hi"] == day(300)
    assert held_on[-1]["carried_from"] is not None
    days = spark.createDataFrame([("a", day(n)) for n in (0, 40, 299, 301)], "k string, d date")
    on = {x["d"]: x["state"] for x in intervals.on_days(days, intervals.carried(one, ["k"], "lo", "hi", F.lit(day(300))), ["k"], "d", "lo", "hi").collect()}
    assert len(on) == 4 and on[day(301)] is None and on[day(299)] == held_on[-1]["state"]


def test_one_state_whatever_the_order(spark):
    """The longest of a day may win or lose, and periods may come twice; without keys all rows are of one."""
    r = random.Random(3)
    rows = [("a", day(lo), day(lo + r.choice([-1, 0, 2, 9, 40])), n, r.choice("xy")) for n in range(80) for lo in [r.randint(0, 9)]]
    rows = [*rows, *rows[:5], (None, day(2), day(5), 99, "x")]
    for keys, order in (["k"], ["rank"]), (["k"], ["hi", "rank"]), ([], ["lo", "rank"]):
        names = ["k", "lo", "hi", "rank", "state"]
        df = spark.createDataFrame(rows, PERIOD)
        own = [dict(zip(names, x)) for x in rows if x[1] <= x[2] and (x[0] or not keys)]
        want = {}
        for n in range(60):
            held = [x for x in own if x["lo"] <= day(n) <= x["hi"]]
            if held:
                want[n] = max(held, key=lambda x: [x[c] for c in order])["state"]
        got = intervals.one_state(df, keys, "lo", "hi", order, ["state"])
        assert got.columns == [*keys, "lo", "hi", "state"]
        found = [((x["lo"] - START).days + i, x["state"]) for x in got.collect() for i in range((x["hi"] - x["lo"]).days + 1)]
        assert sorted(found) == sorted(want.items())


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("keys", [["k"], ["k", "j"], []])
def test_days_meet_every_period_that_holds_on_them(spark, how, keys):
    r = random.Random(5)
    spans = [(r.choice(["a", "b", None]), r.choice([1, 2, None]), day(lo), day(lo + r.choice([-1, 0, 3, 30])), n) for n in range(40) for lo in [r.randint(0, 60)]]
    spans += [*spans[:3], ("a", 1, None, day(9), 90), ("a", 1, day(9), None, 91)]
    rows = [(r.choice(["a", "b", "c", None]), r.choice([1, 2, None]), r.choice([None, *map(day, range(90))]), n) for n in range(60)]
    rows += rows[:5]
    days, periods = spark.createDataFrame(rows, "k string, j int, d date, id int"), spark.createDataFrame(spans, "k string, j int, lo date, hi date, p int")
    if "j" not in keys:
        periods = periods.drop("j")
    if not keys:
        periods = periods.drop("k")
    got = intervals.on_days(days, periods, keys, "d", "lo", "hi", how)
    assert got.columns == ["k", "j", "d", "id", *[c for c in periods.columns if c not in keys]]
    want = []
    for k, j, d, n in rows:
        same = [x for x in spans if ("k" not in keys or k and x[0] == k) and ("j" not in keys or j and x[1] == j)]
        held = [x for x in same if d and x[2] and x[3] and x[2] <= d <= x[3]]
        want += [(n, x[4]) for x in held] or [(n, -1)] * (how == "left")
    assert sorted((x["id"], -1 if x["p"] is None else x["p"]) for x in got.collect()) == sorted(want)


def test_comings_and_goings(spark):
    days = spark.createDataFrame([(1, day(n)) for n in range(0, 400, 10)], "entity int, day date")
    spans = spark.createDataFrame([(1, day(100), day(300)), (1, None, None), (2, day(0), day(1))], "entity int, starts date, ends date")
    got = {(x["day"] - START).days: (x["came"], x["leaves"]) for x in people.comings_and_goings(days, spans, 1).collect()}
    assert len(got) == 40 and sorted(n for n, x in got.items() if x[0]) == [100, 110, 120]  # the same day of the month before is out
    assert sorted(n for n, x in got.items() if x[1]) == [280, 290, 300]


def test_shifts_over_midnight(spark):
    rows = [(1, day(0), 5 * 3600, 13 * 3600), (1, day(0), 22 * 3600, 2 * 3600), (2, day(0), 9 * 3600, 9 * 3600)]
    got = {x["entity"]: tuple(x)[2:] for x in people.shift_days(spark.createDataFrame(rows, "entity int, day date, start_s long, end_s long")).collect()}
    assert got == {1: (5, 2, 21), 2: (9, 9, 0)}


def test_pay_of_months_without_any_is_that_of_neighbours(spark):
    rows = [(1, day(0), 0, 100), (1, day(31), 1000, 100), (1, day(60), 0, None), (1, day(91), 1000, 50), (2, day(31), 500, None), (3, day(60), 0, 100)]
    got = {(x["entity"], (x["month"] - START).days): x for x in people.pay_features(spark.createDataFrame(rows, "entity int, month date, gross int, hours int")).collect()}
    assert [got[1, n]["full_time_pay"] for n in (0, 31, 60, 91)] == [1000.0, 1000.0, 1000.0, 2000.0]
    assert got[2, 31]["full_time_pay"] == 500.0 and got[3, 60]["full_time_pay"] is None and got[3, 60]["level"] == "missing"
    assert got[2, 31]["level"] == "low" and got[1, 31]["level"] == "high"


def test_supplements_of_kinds_found_in_the_data(spark):
    rows = [(1, day(0), "night", 10), (1, day(0), "night", 5), (1, day(20), "meal", 1), (1, day(70), "meal", 2), (2, day(5), None, 7)]
    long = people.supplement_lookback(spark.createDataFrame(rows, "entity int, day date, kind string, amount int"), "kind", "amount", 1)
    got = {((x["day"] - START).days, x["kind"]): (x["number"], x["amount_before"], x["times_before"]) for x in long.collect()}
    assert got == {(0, "night"): (2, 15, 2), (20, "night"): (2, 15, 2), (20, "meal"): (1, 1, 1), (70, "meal"): (1, 2, 1)}
    wide = {(x["day"] - START).days: (x["paid_night"], x["paid_other"]) for x in people.wide_supplements(long, "kind", ["night", "other"]).collect()}
    assert wide == {0: (1, 0), 20: (1, 0), 70: (0, 0)}
