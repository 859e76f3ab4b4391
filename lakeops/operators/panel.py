"""Calendars and dense panels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def day_spine(bounds: DataFrame, first: str, last: str, day: str = "day") -> DataFrame:
    """OP-120: one row per day between two date columns, for every input row."""
    return bounds.select(
        *[c for c in bounds.columns if c not in (first, last)],
        F.explode(F.sequence(F.col(first), F.col(last), F.expr("INTERVAL 1 DAY"))).alias(day),
    )


def day_bounds(df: DataFrame, day: Column, keys: Sequence[str] = ()) -> DataFrame:
    """OP-96: first and last day, overall or per key."""
    return df.groupBy(*keys).agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def complete_panel(
    panel: DataFrame, entity: str, day: str, fills: Mapping[str, object], missing_flag: str = "is_missing"
) -> DataFrame:
    """OP-86: every day between an entity's first and last, absent rows filled and flagged."""
    spine = day_spine(day_bounds(panel, F.col(day), [entity]), "first_day", "last_day", day)
    marked = panel.withColumn("__present", F.lit(True))
    joined = spine.join(marked, [entity, day], "left")
    filled = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()}
    return joined.withColumns(
        {**filled, missing_flag: F.when(F.col("__present").isNull(), 1).otherwise(0)}
    ).drop("__present")


def calendar_columns(day: Column, fiscal_starts: Mapping[str, int] | None = None) -> dict[str, Column]:
    """MART-21: attributes of a day. ``fiscal_starts`` maps a column prefix to the month
    its year starts with."""
    columns = {
        "date_key": F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day),
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "month_key": F.date_format(day, "yyyy-MM"),
        "day_of_month": F.dayofmonth(day),
        "day_of_year": F.dayofyear(day),
        "day_of_week": F.dayofweek(day),
        "weekday_number": F.weekday(day),
        "weekday_name": F.date_format(day, "EEEE"),
        "week_of_year": F.weekofyear(day),
        "is_weekend": F.when(F.weekday(day) >= 5, 1).otherwise(0),
        "is_month_end": F.when(F.last_day(day) == day, 1).otherwise(0),
    }
    for prefix, start in (fiscal_starts or {}).items():
        columns[f"{prefix}_year"] = F.year(day) + F.when((F.month(day) >= start) & F.lit(start > 1), 1).otherwise(0)
        columns[f"{prefix}_period"] = (F.month(day) + (12 - start)) % 12 + 1
        columns[f"{prefix}_quarter"] = (F.floor(((F.month(day) + (12 - start)) % 12) / 3) + 1).cast("int")
    return columns
