"""Entity-day panels: episodes, profiles, typologies and rates (MART-26..31, 34).

A panel has one row per entity and day; an entity's windows are as long as its calendar.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeops.functions.coding import band, first_rule, flag
from lakeops.operators.joins import join_back
from lakeops.operators.lookback import distinct_in_lookback, last_of_month, lookback
from lakeops.operators.summaries import shares_within
from lakeops.operators.timeline import Timeline, fill_agreeing_gaps, rolling_sum, to_date_sum, with_runs

# Inclusive upper bounds in days of the episode length classes.
LENGTH_CLASSES = ((1, "1 day"), (3, "2 to 3 days"), (7, "4 to 7 days"), (31, "8 days to 1 month"), (93, "1 to 3 months"))
LONGEST = "over 3 months"


def panel_line(entity: str = "entity", day: str = "day") -> Timeline:
    return Timeline((entity,), (day,))


def bridge_off_days(panel: DataFrame, off_day: Column) -> DataFrame:
    """Off-days between two flagged days count as flagged (OP-108)."""
    gap = off_day & (F.col("flag") == 0)
    filled = fill_agreeing_gaps(panel, panel_line(), "flag", gap, out="__flag")
    return filled.withColumn("flag", F.when(gap & (F.col("__flag") == 1), 1).otherwise(F.col("flag"))).drop("__flag")


def episodes(panel: DataFrame, kind: str = "kind") -> DataFrame:
    """MART-26: episode id per row. A row continues the episode when it follows the day
    before, has the same kind and is flagged."""

    def breaks(before, here):
        gap = F.datediff(here("day"), before("day"))
        same = here(kind) == before(kind)
        return ~(((gap == 1) & same & (here("flag") == 1)) | ((gap < 1) & same))

    return with_runs(panel, panel_line(), "episode", ["day", kind, "flag"], breaks)


def with_episode_lengths(rows: DataFrame) -> DataFrame:
    """OP-110: first and last day, length in days, days so far and length class."""
    whole = Window.partitionBy("entity", "episode")
    out = rows.withColumns({"first_day": F.min("day").over(whole), "last_day": F.max("day").over(whole)})
    out = out.withColumn("length_days", F.datediff("last_day", "first_day") + 1)
    return out.withColumns(
        {
            "days_so_far": F.datediff("day", "first_day") + 1,
            "length_class": F.when(F.col("flag") == 1, band(F.col("length_days"), LENGTH_CLASSES, LONGEST)).otherwise("none"),
        }
    )


def with_headcount(rows: DataFrame) -> DataFrame:
    """OP-78: entities present per day on every row. Panel rows are unique per entity and
    day, so counting rows counts entities."""
    return join_back(rows, ["day"], headcount=F.count(F.lit(1)))


def episode_panel(panel: DataFrame, off_day: Column) -> DataFrame:
    """MART-26 in full: bridge off-days, number episodes, measure them, add the headcount."""
    rows = with_headcount(with_episode_lengths(episodes(bridge_off_days(panel, off_day))))
    return rows.withColumn("month", F.date_format("day", "yyyy-MM"))


def time_profile(
    panel: DataFrame, categories: Mapping[str, Mapping[str, Column]], thresholds: Mapping[str, tuple[str, float]],
    months: int = 3,
) -> DataFrame:
    """MART-27: shares of day classes over the preceding months, and flags on them.

    ``categories`` groups conditions whose counts are shared out together; ``thresholds``
    maps an output flag to (share column, bound).
    """
    conditions = {name: cond for group in categories.values() for name, cond in group.items()}
    marked = panel.withColumns({f"__{n}": flag(c) for n, c in conditions.items()})
    counted = lookback(marked, "entity", "day", months, {n: f"__{n}" for n in conditions})
    shared = shares_within(counted, {g: list(members) for g, members in categories.items()})
    return shared.withColumns(
        {out: flag(F.col(share) > bound) for out, (share, bound) in thresholds.items()}
    ).drop(*[f"__{n}" for n in conditions])


def frequency_typology(rows: DataFrame, rules: Sequence[tuple], otherwise: str, months: int = 3) -> DataFrame:
    """MART-28: episodes and flagged days over ``(d - months, d]``, taken at the last day of
    the entity's month, as a typology."""
    marked = rows.withColumn("__episode", F.when(F.col("flag") == 1, F.col("episode")))
    marked = lookback(marked, "entity", "day", months, {"flagged_days": "flag"}, include_today=True, include_edge=False)
    marked = distinct_in_lookback(marked, "entity", "day", months, "__episode", "episodes").drop("__episode", "days_seen")
    marked = last_of_month(marked, "entity", "day", "episodes", "month_episodes")
    marked = last_of_month(marked, "entity", "day", "flagged_days", "month_flagged_days")
    return marked.withColumn("typology", typology(F.col("month_episodes"), F.col("month_flagged_days"), rules, otherwise))


def typology(count: Column, days: Column, rules: Sequence[tuple], otherwise: str) -> Column:
    """OP-61: ordered rules (most occurrences, fewest days, most days or None, label) of the caller; the first that holds."""
    conditions = [
        ((count <= most) & (days >= fewest) & (F.lit(True) if longest is None else days <= longest), label)
        for most, fewest, longest, label in rules
    ]
    return first_rule(conditions, otherwise)


def value_runs(series: DataFrame, value: str, order: str, recent_days: int = 190, old_days: int = 890) -> DataFrame:
    """MART-30: how long a value (pay, say) has been unchanged, in days, and its age class.

    ``series`` has one row per entity and period start (a date in ``order``).
    """
    line = Timeline(("entity",), (order,))
    runs = with_runs(series, line, "run", [value], lambda before, here: before(value) != here(value))
    step = F.coalesce(F.datediff(F.col(order), F.lag(order).over(Window.partitionBy("entity").orderBy(order))), F.lit(30))
    aged = runs.withColumn("__step", step).withColumn(
        "days_unchanged", to_date_sum("__step", ["entity", "run"], [order])
    )
    return aged.withColumn(
        "change_age",
        F.when(F.col("days_unchanged") < recent_days, "recent")
        .when(F.col("days_unchanged") >= old_days, "old")
        .otherwise("between"),
    ).drop("__step")


def monthly_rates(panel: DataFrame, amount: str, causes: Mapping[str, Sequence[str]], kind: str = "kind") -> DataFrame:
    """MART-34: flagged share of an amount per cause: month, last 12 months, year to date.

    Rows without the flag are the common base of every cause. One pass counts all causes;
    the result has one row per cause and month.
    """
    month = [F.year("day").alias("year"), F.month("day").alias("month")]
    flagged, value = F.col("flag") == 1, F.col(amount)
    sums = [F.sum(F.when(~flagged, value).otherwise(0)).alias("__present")]
    for cause, kinds in causes.items():
        sums.append(F.sum(F.when(flagged & F.col(kind).isin(list(kinds)), value).otherwise(0)).alias(cause))
    months = panel.groupBy(*month).agg(*sums)
    long = months.unpivot(["year", "month", "__present"], list(causes), "cause", "flagged").withColumn(
        "total", F.col("flagged") + F.col("__present")
    )
    order = ["year", "month"]
    wide = long.withColumns(
        {
            "f12": rolling_sum("flagged", ["cause"], order, 12),
            "t12": rolling_sum("total", ["cause"], order, 12),
            "fy": to_date_sum("flagged", ["cause", "year"], order),
            "ty": to_date_sum("total", ["cause", "year"], order),
        }
    )
    return wide.select(
        "year",
        "month",
        "cause",
        F.try_divide(F.col("flagged").cast("double"), F.col("total").cast("double")).alias("rate_month"),
        F.try_divide(F.col("f12").cast("double"), F.col("t12").cast("double")).alias("rate_12_months"),
        F.try_divide(F.col("fy").cast("double"), F.col("ty").cast("double")).alias("rate_year_to_date"),
    )


def long_rates(rates: DataFrame) -> DataFrame:
    return rates.unpivot(
        ["year", "month", "cause"], ["rate_month", "rate_12_months", "rate_year_to_date"], "variable", "value"
    )


def travel_bands(
    pairs: DataFrame, matrix: DataFrame, bounds: Sequence[tuple[float, str]], above: str, default: float
) -> DataFrame:
    """OP-153: distinct (entity, site) pairs with their distance from a matrix, banded."""
    distinct = pairs.select("entity", "site").distinct()
    known = distinct.join(matrix, ["entity", "site"], "left").withColumn("distance", F.coalesce("distance", F.lit(default)))
    return known.withColumn("distance_band", band(F.col("distance"), bounds, above))
