"""Chunked timelines against plain windows."""

import datetime as dt
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lakeops.functions.clock import epoch_micros, epoch_seconds, seconds_to_ntz
from lakeops.operators import timeline as tl

DDL = "k string, o int, i int, v int"


def rows_of(seed, n=120):
    r = random.Random(seed)
    keys = ["hot", "hot", "hot", "a", "b", None]
    return [(r.choice(keys), r.randint(0, 40), i, r.choice([None, None, 1, 2, 3])) for i in range(n)]


def both(spark, rows, features, width=7):
    df = spark.createDataFrame(rows, DDL)
    plain = tl.along(df, tl.Timeline(("k",), ("o", "i")), features)
    chunked = tl.along(df, tl.Timeline(("k",), ("o", "i"), tl.every_number("o", width)), features)
    key = lambda r: r["i"]
    return sorted(plain.collect(), key=key), sorted(chunked.collect(), key=key)


def features():
    return {
        "before": tl.previous("v"),
        "before_or_zero": tl.previous("v", default=0),
        "total": tl.running_total("v"),
        "rank": tl.position(),
        "back": tl.last_known("v"),
        "ahead": tl.next_known("v"),
    }


@pytest.mark.parametrize("seed,width", [(1, 1), (2, 7), (3, 13), (4, 1000)])
def test_features_do_not_depend_on_chunks(spark, seed, width):
    plain, chunked = both(spark, rows_of(seed), features(), width)
    assert plain == chunked
    assert plain[0].asDict().keys() == {"k", "o", "i", "v", *features()}


def test_peers_share_the_running_total(spark):
    df = spark.createDataFrame(rows_of(5), DDL)
    feature = {"total": tl.running_total("v", peers_share=True)}
    plain = tl.along(df, tl.Timeline(("k",), ("o",)), feature)
    chunked = tl.along(df, tl.Timeline(("k",), ("o",), tl.every_number("o", 5)), feature)
    assert sorted(map(str, plain.collect())) == sorted(map(str, chunked.collect()))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["h", "x"]), st.integers(0, 9), st.sampled_from([1, 2, None])), min_size=1, max_size=25),
       st.integers(1, 6))
def test_runs_do_not_depend_on_chunks(spark, drawn, width):
    df = spark.createDataFrame([(k, o, i, v) for i, (k, o, v) in enumerate(drawn)], DDL)

    def breaks(before, here):
        return (before("v") != here("v")) | (here("o") - before("o") > 2)

    plain = tl.with_runs(df, tl.Timeline(("k",), ("o", "i")), "run", ["o", "v"], breaks)
    chunked = tl.with_runs(df, tl.Timeline(("k",), ("o", "i"), tl.every_number("o", width)), "run", ["o", "v"], breaks)
    assert sorted(map(str, plain.collect())) == sorted(map(str, chunked.select(plain.columns).collect()))


def test_runs_number_from_one_and_partition_rows(spark):
    df = spark.createDataFrame([("a", i, i, v) for i, v in enumerate([1, 1, 2, 2, 1])], DDL)
    out = tl.with_runs(df, tl.Timeline(("k",), ("o",)), "run", ["v"], lambda b, h: b("v") != h("v"))
    assert [r["run"] for r in out.orderBy("o").collect()] == [1, 1, 2, 2, 3]


def test_forward_fill_never_changes_known_values(spark):
    df = spark.createDataFrame(rows_of(9), DDL)
    out = tl.along(df, tl.Timeline(("k",), ("o", "i"), tl.every_number("o", 4)), {"back": tl.last_known("v")})
    assert out.filter("v IS NOT NULL AND v <> back").count() == 0


def test_leading_and_trailing_gaps(spark):
    df = spark.createDataFrame([("a", i, i, v) for i, v in enumerate([None, -1, None, None])], DDL)
    line = tl.Timeline(("k",), ("o",), tl.every_number("o", 2))
    out = tl.along(df, line, {"back": tl.last_known("v"), "ahead": tl.next_known("v")}).orderBy("o").collect()
    assert [r["back"] for r in out] == [None, -1, -1, -1]
    assert [r["ahead"] for r in out] == [-1, -1, None, None]
    both_ways = tl.fill_both_ways(df, line, "v").orderBy("o").collect()
    assert [r["v"] for r in both_ways] == [-1, -1, -1, -1]


def test_gaps_fill_only_between_agreeing_neighbours(spark):
    values = [1, None, 1, None, 2, None]
    df = spark.createDataFrame([("a", i, i, v) for i, v in enumerate(values)], DDL)
    out = tl.fill_agreeing_gaps(df, tl.Timeline(("k",), ("o",)), "v", F.col("v").isNull())
    assert [r["v"] for r in out.orderBy("o").collect()] == [1, 1, 1, None, 2, None]


def test_calendar_flags(spark):
    days = [(dt.date(2024, 1, 1) + dt.timedelta(i), int(i in (3, 9))) for i in range(12)]
    df = spark.createDataFrame(days, "day date, f int")
    out = df.select(
        "day", tl.calendar_flag_nearby("day", "f", 2, 2).alias("near"), tl.calendar_flag_recent("day", "f", 2).alias("recent")
    ).orderBy("day").collect()
    assert [r["near"] for r in out] == [0, 1, 1, 1, 1, 1, 0, 1, 1, 1, 1, 1]
    assert [r["recent"] for r in out] == [0, 0, 0, 0, 1, 1, 0, 0, 0, 0, 1, 1]


def test_rolling_with_a_missing_month_is_row_based(spark):
    df = spark.createDataFrame([("a", 2023, m, 1) for m in (1, 2, 4)] + [("a", 2024, 1, 1)], "k string, y int, m int, v int")
    out = df.select(
        "y", "m", tl.rolling_sum("v", ["k"], ["y", "m"], 3).alias("r"), tl.to_date_sum("v", ["k", "y"], ["m"]).alias("ytd")
    ).orderBy("y", "m").collect()
    assert [(r["r"], r["ytd"]) for r in out] == [(1, 1), (2, 2), (3, 3), (3, 1)]


def test_chunked_plan_never_groups_rows_by_key_alone(spark):
    df = spark.createDataFrame(rows_of(1), DDL)
    out = tl.along(df, tl.Timeline(("k",), ("o", "i"), tl.every_number("o", 7)), {"rank": tl.position()})
    plan = out._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert any("__chunk" in w and "__edge" in w for w in windows) and len(windows) == 2


@pytest.mark.parametrize("size", [1, 64, 640])
def test_splitters_cut_a_key_even_at_one_instant(spark, size):
    start = dt.datetime(2024, 1, 1)
    rows = [("hot", i, start, i % 3) for i in range(3_000)] + [("even", i, start + dt.timedelta(seconds=i), 1) for i in range(900)]
    rows += [("cold", 9_000, start, 2), (None, 9_001, start, 2), (None, 9_002, start, None)]
    df = spark.createDataFrame(rows, "k string, i int, t timestamp_ntz, v int").repartition(5)
    line = tl.Timeline(("k",), ("t", "i"), size)
    sizes = {(r["k"], r["__chunk"]): r["count"] for r in line.cut(df).groupBy("k", "__chunk").count().collect()}
    assert max(sizes.values()) <= max(2 * size, 3) and sum(n for (k, _), n in sizes.items() if k in ("cold", None)) == 3
    assert sum(k == "hot" for k, _ in sizes) >= 3_000 // size * 0.6
    plain = tl.along(df, tl.Timeline(("k",), ("t", "i")), features())
    assert sorted(map(str, tl.along(df, line, features()).collect())) == sorted(map(str, plain.collect()))
    breaks = lambda before, here: before("v") != here("v")
    runs = [sorted(map(str, tl.with_runs(df, x, "run", ["v"], breaks).select("i", "run").collect())) for x in (line, tl.Timeline(("k",), ("t", "i")))]
    assert runs[0] == runs[1]


def test_splitters_run_no_job_before_the_plan(spark):
    df = spark.range(1000).select(F.lit("k").alias("k"), F.col("id").alias("i"), F.lit(1).alias("v"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("splitters", "")
    tl.along(df, tl.Timeline(("k",), ("i",), 50), {"n": tl.position()})
    assert not tracker.getJobIdsForGroup("splitters")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_few_rows_have_no_splitters(spark):
    df = spark.createDataFrame(rows_of(2), DDL)
    assert df.select(F.size(tl.splitters(df, ["k"], ["o", "i"])).alias("n")).first()["n"] == 0


def test_slices_keep_to_the_clock_where_a_zone_skips_an_hour(spark):
    """02:30 and 03:10 of a spring night are in order, whatever the session zone makes of them."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    stamps = [dt.datetime(2024, 3, 31, h, m, 0, 5) for h, m in ((1, 50), (2, 30), (3, 10), (3, 40))]
    df = session.createDataFrame([("a", t, i) for i, t in enumerate(stamps)], "k string, t timestamp_ntz, i int")
    numbered = tl.along(df, tl.Timeline(("k",), ("t", "i"), tl.every("t", 1800)), {"n": tl.position()})
    assert [r["n"] for r in numbered.orderBy("i").collect()] == [1, 2, 3, 4]
    micros = df.select("i", epoch_micros(F.col("t")).alias("us"), seconds_to_ntz(epoch_seconds(F.col("t"))).alias("s")).orderBy("i").collect()
    assert [r["us"] for r in micros] == [int((t - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1)) for t in stamps]
    assert [r["s"] for r in micros] == [t.replace(microsecond=0) for t in stamps]
