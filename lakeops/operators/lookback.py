"""OP-77: calendar-month lookbacks without a self-join.

Rows are reduced to one per (entity, day) first, so an entity's window is as long as its
calendar at most; the month-bounded frame then reads neighbours in place. A self-join on
(entity, date range) would emit every pair of days.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F


def daily(df: DataFrame, entity: str, day: str, sums: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(entity, day).agg(*[F.sum(c).alias(n) for n, c in sums.items()])


def _frame(entity: str, day: str, months: int, ahead: bool):
    return f"(PARTITION BY `{entity}` ORDER BY `{day}` RANGE BETWEEN " + (
        f"CURRENT ROW AND INTERVAL {months} MONTH FOLLOWING)"
        if ahead
        else f"INTERVAL {months} MONTH PRECEDING AND CURRENT ROW)"
    )


def lookback(
    days: DataFrame,
    entity: str,
    day: str,
    months: int,
    sums: Mapping[str, str],
    ahead: bool = False,
    include_today: bool = False,
    include_edge: bool = True,
) -> DataFrame:
    """Sums over the months before (or after) each day of a one-row-per-day frame.

    The frame holds both ends; the excluded ones are taken off again, which is exact for
    counts and decimals. ``days_seen`` counts the days in the window. Bounds:
    ``[d-k, d)`` is the default, ``(d-k, d]`` has ``include_today=True,
    include_edge=False``, and ``ahead`` mirrors them.
    """
    over = _frame(entity, day, months, ahead)
    edge_day = F.add_months(F.col(day), months if ahead else -months)
    edge_pick = "last_value" if ahead else "first_value"
    at_edge = F.expr(f"{edge_pick}(`{day}`) OVER {over}") == edge_day
    columns = {}
    counted = {**sums, "days_seen": None}
    for out, source in counted.items():
        value = f"`{source}`" if source else "1"
        total = F.expr(f"sum(coalesce({value}, 0)) OVER {over}")
        if not include_edge:
            total = total - F.when(at_edge, F.expr(f"{edge_pick}(coalesce({value}, 0)) OVER {over}")).otherwise(F.lit(0))
        if not include_today:
            total = total - F.expr(f"coalesce({value}, 0)")
        columns[out] = total
    return days.withColumns(columns)


def distinct_in_lookback(
    days: DataFrame, entity: str, day: str, months: int, value: str, out: str, include_today: bool = True
) -> DataFrame:
    """Distinct non-null values over ``(d-k, d]`` (or ``(d-k, d)``) of a one-row-per-day frame."""
    over = _frame(entity, day, months, ahead=False)
    seen = F.expr(f"collect_list(named_struct('d', `{day}`, 'v', `{value}`)) OVER {over}")
    low = F.add_months(F.col(day), -months)

    def inside(x):
        upper = x["d"] <= F.col(day) if include_today else x["d"] < F.col(day)
        return (x["d"] > low) & upper & x["v"].isNotNull()

    return days.withColumn("__seen", seen).withColumn(
        out, F.size(F.array_distinct(F.transform(F.filter("__seen", inside), lambda x: x["v"])))
    ).drop("__seen")


def last_of_month(days: DataFrame, entity: str, day: str, value: str, out: str) -> DataFrame:
    """OP-113: the value on the last day of each entity's month, on every row of the month."""
    month = Window.partitionBy(entity, F.trunc(F.col(day), "month"))
    return days.withColumn(out, F.max_by(F.col(value), F.col(day)).over(month))
