import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeops.functions import clock, coding, geo, hashing, validity


def ts(text):
    return dt.datetime.fromisoformat(text)


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()["x"]


def stamp(text):
    return F.lit(text).cast("timestamp_ntz")


def day(text):
    return F.lit(text).cast("date")


@pytest.mark.parametrize("at,service,want", [
    ("2024-01-01 03:59:00", "2024-01-01", "03:59"), ("2024-01-02 00:05:00", "2024-01-01", "24:05"),
    ("2024-01-02 03:59:59", "2024-01-01", "27:59"), ("2024-01-06 03:00:00", "2024-01-01", "123:00"),
])
def test_service_clock(spark, at, service, want):
    assert one(spark, clock.service_clock(stamp(at), day(service))) == want
    assert one(spark, clock.service_clock(stamp(at), day(service), truncate_to_two=True)) == want[-5:]


@pytest.mark.parametrize("end,plain,wrapped", [
    ("2024-01-01 12:00:59", "00:00", "00:00"), ("2024-01-02 13:30:00", "25:30", "01:30"), ("2024-01-01 11:00:00", "-01:00", "23:00"),
])
def test_durations(spark, end, plain, wrapped):
    start = stamp("2024-01-01 12:00:00")
    assert one(spark, clock.duration_text(start, stamp(end))) == plain
    assert one(spark, clock.duration_text(start, stamp(end), wrap=True)) == wrapped


def test_operating_day_turns_at_the_cutoff(spark):
    assert one(spark, clock.operating_day(stamp("2024-03-01 03:59:59"))) == dt.date(2024, 2, 29)
    assert one(spark, clock.operating_day(stamp("2024-03-01 04:00:00"))) == dt.date(2024, 3, 1)
    assert one(spark, clock.operating_stamp(stamp("2024-03-01 03:10:00"))) == ts("2024-02-29 00:00:00")
    assert one(spark, clock.operating_stamp(stamp("2024-03-01 13:10:00"))) == ts("2024-03-01 13:10:00")


def test_actual_time_and_shift(spark):
    assert one(spark, clock.actual_time(stamp("2024-01-01 23:59:30"), F.lit(45))) == ts("2024-01-02 00:00:15")
    assert one(spark, clock.shift_span_hours(F.lit(20 * 3600), F.lit(2 * 3600))) == 6.0
    assert one(spark, clock.shift_span_hours(F.lit(5 * 3600), F.lit(13 * 3600 + 1800))) == 8.5


def test_time_of_day(spark):
    assert one(spark, clock.time_of_day_text(F.lit(7.5), "hours")) == "07:30"
    assert one(spark, clock.time_of_day_text(F.lit(90061), "seconds")) == "25:01"
    assert one(spark, clock.time_of_day_text(F.lit(" 08:15:59"), "text")) == "08:15"
    with pytest.raises(ValueError):
        clock.time_of_day_text(F.lit(1), "fortnights")


def test_epochs(spark):
    assert one(spark, clock.from_epoch(F.lit(1424686734992), "ms").cast("string")) == "2015-02-23 10:18:54.992"
    assert one(spark, clock.from_epoch(F.lit(1424686734992123456), "ns").cast("string")) == "2015-02-23 10:18:54.992123"


def test_codes(spark):
    assert one(spark, coding.decode_flag(F.lit("N"), {"Y": "yes", "N": "no"})) == "no"
    assert one(spark, coding.decode_flag(F.lit(None).cast("string"), {"Y": "yes"})) == ""
    assert one(spark, coding.code_map(F.lit("Z"), {"A": "1"}, F.lit("Z").substr(1, 1))) == "Z"
    assert one(spark, coding.code_map(F.lit("Z"), {}, "d")) == "d"


@pytest.mark.parametrize("value,want", [(1, "low"), (3, "low"), (3.5, "mid"), (7, "mid"), (8, "high"), (None, None)])
def test_bands(spark, value, want):
    assert one(spark, coding.band(F.lit(value).cast("double"), [(3, "low"), (7, "mid")], "high")) == want


def test_text_numbers_and_dates(spark):
    assert one(spark, coding.decimal_comma(F.lit("1 234,5"))) == 1234.5
    assert one(spark, coding.decimal_comma(F.lit("n/a"))) is None
    assert one(spark, coding.decimal_comma(F.lit(""))) is None
    formats = ["dd/MM/yyyy", "yyyy-MM-dd"]
    assert one(spark, coding.parse_date(F.lit("29/02/2024"), formats)) == dt.date(2024, 2, 29)
    assert one(spark, coding.parse_date(F.lit("2024-02-29"), formats)) == dt.date(2024, 2, 29)
    assert one(spark, coding.parse_date(F.lit("31/02/2024"), formats)) is None
    assert one(spark, coding.repair_scale(F.lit(2.5), 214, 1e7)) == 2.5e7
    assert one(spark, coding.repair_scale(F.lit(-300.0), 214, 1e7)) == -300.0


def test_slugs_and_one_hot(spark):
    assert coding.slug("  Été à l'École (no. 1) ") == "ete_a_l_ecole_no_1"
    df = spark.createDataFrame([(1, 2, 3)], ["A b", "a B", "c"])
    assert coding.slug_columns(df).columns == ["a_b", "a_b_2", "c"]
    assert coding.slug_columns(spark.createDataFrame([(1, 2, 3)], ["a", "A", "a 2"])).columns == ["a", "a_2", "a_2_2"]
    values = spark.createDataFrame([("x y",), ("z",), ("missing",), (None,)], "v string")
    known = sorted(r[0] for r in coding.known_values(values, "v").collect())
    assert known == ["missing", "x y", "z"]
    hot = coding.one_hot(values, "v", known, "is_")
    assert hot.columns == ["v", "is_x_y", "is_z"]
    assert [tuple(r)[1:] for r in hot.collect()] == [(1, 0), (0, 1), (0, 0), (0, 0)]
    assert coding.known_values(spark.range(2_000), "id").count() == 2_000


def test_flags_and_counts(spark):
    df = spark.createDataFrame([(5, None, 30, 1)], "a int, b int, c int, f int")
    assert df.select(coding.count_where(["a", "b", "c"], lambda c: c <= 20)).first()[0] == 1
    assert df.select(coding.flag_total(["f", "b"])).first()[0] == 1
    assert coding.constant_placeholder(df, ["a", "b"], "-").select("a", "b").first() == ("-", "-")


def test_hash_ignores_column_order_and_can_see_nulls(spark):
    df = spark.createDataFrame([(1, None, "a", (1, "s"))], "x int, y string, z string, n struct<p int, q string>")
    a = df.select(hashing.row_hash(df)).first()[0]
    turned = df.select("z", "n", "y", "x")
    assert turned.select(hashing.row_hash(turned)).first()[0] == a
    less = df.drop("y")
    assert less.select(hashing.row_hash(less)).first()[0] == a, "nulls are skipped by default"
    assert df.select(hashing.row_hash(df, null_token="~")).first()[0] != a
    floats = spark.createDataFrame([(1e7,)], "v double")
    fixed = floats.select(hashing.row_hash(floats, number_formats={"v": "decimal(18,2)"})).first()[0]
    import hashlib

    assert fixed == hashlib.sha256(b"10000000.00").hexdigest()
    marked = hashing.with_identity(df, "load-9").first()
    assert marked["row_bucket"] == a[0] and marked["first_load_id"] == marked["last_load_id"] == "load-9"




def window(spark, sold, start, end, family, aligned):
    rows = spark.createDataFrame([(sold, start, end)], "s date, f date, t date")
    annual, monthly = F.lit(family == "annual"), F.lit(family == "monthly")
    s, f, t = F.col("s"), F.col("f"), F.col("t")
    out = rows.select(validity.validity_start(s, f, annual, aligned), validity.validity_end(s, f, t, annual, monthly, aligned)).first()
    return tuple(d.isoformat() for d in out)


@pytest.mark.parametrize("sold,start,end,family,aligned,want", [
    ("2021-01-31", None, None, "annual", False, ("2021-01-31", "2021-12-31")),
    ("2024-03-31", None, None, "annual", False, ("2024-03-31", "2025-02-28")),
    ("2024-02-10", None, None, "monthly", False, ("2024-02-10", "2024-02-29")),
    ("2024-02-10", None, None, "other", False, ("2024-02-10", "2024-02-10")),
    ("2024-02-10", "2024-03-05", "2024-04-01", "other", False, ("2024-03-05", "2024-04-01")),
    ("2021-10-15", "2021-09-20", None, "annual", True, ("2021-10-01", "2022-09-30")),
    ("2021-10-15", "2021-11-20", "2021-12-01", "annual", True, ("2021-11-01", "2022-10-31")),
])
def test_validity(spark, sold, start, end, family, aligned, want):
    to = lambda v: v and dt.date.fromisoformat(v)
    assert window(spark, to(sold), to(start), to(end), family, aligned) == want


def test_coordinates_round_trip(spark):
    import math

    zone = geo.conic_zone_cc(45)
    e, n, big_f, rho0 = geo._parameters(zone)
    lon, lat = 3.87, 44.95
    phi, lam = math.radians(lat), math.radians(lon - zone.origin_lon)
    t = math.tan(math.pi / 4 - phi / 2) / ((1 - e * math.sin(phi)) / (1 + e * math.sin(phi))) ** (e / 2)
    rho = zone.semi_major * big_f * t**n
    x, y = zone.false_easting + rho * math.sin(n * lam), zone.false_northing + rho0 - rho * math.cos(n * lam)
    got = spark.range(1).select(*geo.to_lonlat(F.lit(x), F.lit(y), zone)).first()
    assert abs(got[0] - lon) < 1e-9 and abs(got[1] - lat) < 1e-9
    origin = spark.range(1).select(*geo.to_lonlat(F.lit(1_700_000.0), F.lit(4_200_000.0), zone)).first()
    assert abs(origin[0] - 3) < 1e-9 and abs(origin[1] - 45) < 1e-9
