"""Calendar marts (MART-21, 32, 33). Frames hold one row per day, so windows over the whole
calendar are small by nature."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lakeops.functions.coding import flag
from lakeops.operators.intervals import on_days, union
from lakeops.operators.panel import calendar_columns, day_spine
from lakeops.operators.reshape import melt
from lakeops.operators.summaries import calendar_quantile
from lakeops.operators.timeline import calendar_flag_nearby, calendar_flag_recent


def calendar_dimension(bounds: DataFrame, fiscal_starts: Mapping[str, int] | None = None) -> DataFrame:
    """MART-21: from a one-row frame (first_day, last_day)."""
    days = day_spine(bounds, "first_day", "last_day", "day")
    return days.select("day", *[c.alias(n) for n, c in calendar_columns(F.col("day"), fiscal_starts).items()])


def calendar_effects(
    days: DataFrame, holiday: str, extremes: Mapping[str, tuple[str, str]], reach: int = 2
) -> DataFrame:
    """MART-33: days near a holiday, weekday flags and extreme-value flags.

    ``days`` is read once per extreme: give it materialised when it summarises a fact.
    ``extremes`` maps an output flag to (measure, probability).
    """
    flags = {"near_holiday": calendar_flag_nearby("day", holiday, reach, reach)}
    for name, (measure, probability) in extremes.items():
        flags[name] = flag(F.col(measure) >= calendar_quantile(days, measure, probability))
    names = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
    return days.withColumns({**flags, **{n: flag(F.weekday("day") == i) for i, n in enumerate(names)}})


def all_calendar_effects(
    days: DataFrame,
    nearby: Mapping[str, str],
    peaks: Mapping[str, tuple[str, str]],
    together: Mapping[str, Sequence[str]],
    outside: Mapping[str, tuple[str, float, str, float]],
    periods: DataFrame,
    zone: str,
    reach: int = 2,
) -> DataFrame:
    """MART-33 from all its sources: 0/1 flags per day.

    ``nearby``: flags within ``reach`` days of a marked one (holidays, feasts, snow). ``peaks``: measures at or
    above a quantile of theirs (epidemics), and ``together`` any of several flags. ``outside``: a low measure
    under or a high one over a bound (extreme temperatures); unknown ones count as 0. ``periods``: (zone, starts,
    ends) that may overlap (school holidays); days in those of ``zone`` are flagged. Weekend, workday, Monday
    and Friday come with it. ``days`` is read once per peak: give it materialised when it summarises a fact.
    """
    flags = {out: calendar_flag_nearby("day", source, reach, reach) for out, source in nearby.items()}
    for out, (measure, probability) in peaks.items():
        flags[out] = flag(F.col(measure) >= calendar_quantile(days, measure, probability))
    for out, (low, least, high, most) in outside.items():
        flags[out] = flag((F.col(low) < least) | (F.col(high) > most))
    merged = union(periods, ["zone"], "starts", "ends").filter(F.col("zone") == zone).select("starts", "ends")
    off = on_days(days.select("day"), merged, [], "day", "starts", "ends", "inner").select("day", F.lit(1).alias("in_period"))
    out = days.withColumns(flags).join(off, "day", "left").fillna(0, ["in_period"])
    out = out.withColumns({name: flag(reduce(lambda x, y: x | y, [F.col(c) == 1 for c in members])) for name, members in together.items()})
    weekday = F.weekday("day")
    return out.withColumns({"weekend": flag(weekday >= 5), "workday": flag(weekday < 5), "monday": flag(weekday == 0), "friday": flag(weekday == 4)})


def melted_calendar(effects: DataFrame, flags: Sequence[str]) -> DataFrame:
    """MART-33, long form: one row per day and flag."""
    return melt(effects, ["day"], flags, "effect", "value")


def pressure_flags(
    calendar: DataFrame, counts: DataFrame, measures: Mapping[str, str], probability: str = "0.95", recent: int = 2
) -> DataFrame:
    """MART-32: days with many cases, and the quiet days right after them.

    ``counts`` has one row per day and is read once per measure: give it materialised when
    it summarises a fact. ``measures`` maps a count column to its output prefix.
    """
    peaks = {
        f"{prefix}_peak": flag(F.col(measure) >= calendar_quantile(counts, measure, probability))
        for measure, prefix in measures.items()
    }
    out = calendar.join(counts, "day", "left").withColumns(peaks)
    after = {f"{p}_recent": calendar_flag_recent("day", p, recent) for p in peaks}
    any_peak = reduce(lambda x, y: x | y, [F.col(p) == 1 for p in peaks])
    return out.withColumns({**after, "any_peak": flag(any_peak)})
