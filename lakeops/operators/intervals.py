"""Periods per key: union, one state at a time, carry-forward, and days against them.

Bounds are dates and inclusive. A period is one row where rows are shuffled; only a day that is asked for and held on
is a row of its own. The windows are over the periods of a key, which are few by nature (a person's contracts, the
holidays of a zone), and so are its days in one array.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeops.operators.joins import band_join
from lakeops.operators.timeline import Timeline, along, count_upto, latest_maximum, previous, running_total


def union(periods: DataFrame, keys: Sequence[str], low: str, high: str, apart: int = 1) -> DataFrame:
    """Per key the periods merged where they overlap, or where the next begins at most ``apart`` after the end.

    A period begins a new one if it begins beyond the largest end of all before it, so a short one
    inside a long one doesn't cut it. Periods with a null bound, or that end before they begin, count for nothing.
    """
    keys = list(keys)
    given = periods.filter(F.col(low) <= F.col(high)).select(*keys, low, high).distinct()
    order = (low, high)
    reached = along(given, Timeline(tuple(keys), order), {"__reached": latest_maximum(high)})
    starts = F.when(F.datediff(F.col(low), F.col("__reached")) <= apart, 0).otherwise(1)
    numbered = along(reached.withColumn("__starts", starts), Timeline(tuple(keys), order), {"__nth": running_total("__starts")})
    return numbered.groupBy(*keys, "__nth").agg(F.min(low).alias(low), F.max(high).alias(high)).drop("__nth")


def one_state(periods: DataFrame, keys: Sequence[str], low: str, high: str, order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Per key disjoint periods with one state each: where periods overlap, the one greatest in ``order`` holds.

    Cut at every beginning and behind every end, a key's time falls into pieces in which the same periods hold.
    A key's cuts are one sorted array, as long as the calendar at most: each period finds the pieces it holds in there,
    so the cost follows the overlaps, not the pairs, and a period is shuffled, not its pieces. Of periods that begin on
    one day only those come to their key that none as long or longer is greater than.
    Neighbouring pieces of one state are one row. ``order`` has to tell periods of a key apart.
    """
    keys, values = list(keys), list(values)
    if not keys:
        return one_state(periods.withColumn("__all", F.lit(1)), ["__all"], low, high, order, values).drop("__all")
    given = periods.filter(F.col(low) <= F.col(high))
    cuts = _days(given.select(*keys, F.explode(F.array(F.col(low), F.date_add(F.col(high), 1))).alias("__cut")), keys, "__cut")
    rank, state = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)]), F.struct(*values)
    longer = Window.partitionBy(*keys, low).orderBy(F.col(high).desc(), F.col("__rank").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranked = given.select(*keys, low, high, rank.alias("__rank"), state.alias("__state")).withColumn("__above", F.max("__rank").over(longer))
    seen = ranked.filter(F.col("__above").isNull() | (F.col("__rank") > F.col("__above"))).drop("__above")
    held = seen.join(cuts.hint("merge"), keys)
    first, behind = count_upto(F.col("__days"), F.col(low)), count_upto(F.col("__days"), F.date_add(F.col(high), 1))
    held = held.withColumns({"__first": first, "__number": behind - first})
    held = held.withColumns({"__from": F.slice("__days", F.col("__first"), F.col("__number")), "__next": F.slice("__days", F.col("__first") + 1, F.col("__number"))})
    met = held.select(*keys, "__rank", "__state", F.inline(F.arrays_zip("__from", "__next")))
    best = met.groupBy(*keys, "__from", "__next").agg(F.max_by("__state", "__rank").alias("__state"))
    return _joined(best.withColumn("__to", F.date_sub("__next", 1)), keys, "__from", "__to", "__state").select(
        *keys, F.col("__from").alias(low), F.col("__to").alias(high), "__state.*"
    )


def _days(rows: DataFrame, keys: list[str], day: str) -> DataFrame:
    """The days of each key in one sorted array."""
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_set(day)).alias("__days"))


def _joined(pieces: DataFrame, keys: list[str], low: str, high: str, state: str) -> DataFrame:
    """Pieces that follow each other with one state, as one."""
    line = Timeline(tuple(keys), (low,))
    seen = along(pieces, line, {"__before": previous(F.struct(F.col(high).alias("high"), F.col(state).alias("state")))})
    goes_on = (F.date_add(F.col("__before.high"), 1) == F.col(low)) & F.col("__before.state").eqNullSafe(F.col(state))
    marked = seen.withColumn("__starts", F.when(goes_on, 0).otherwise(1)).drop("__before")
    numbered = along(marked, line, {"__nth": running_total("__starts")})
    # A piece of a run has its state: any will do.
    runs = numbered.groupBy(*keys, "__nth").agg(F.min(low).alias(low), F.max(high).alias(high), F.min_by(state, low).alias(state))
    return runs.drop("__nth")


def carried(periods: DataFrame, keys: Sequence[str], low: str, high: str, until: Column) -> DataFrame:
    """Disjoint periods whose state holds on over the gap behind them: up to the day before the next one, the last up
    to ``until``. ``carried_from`` is the first day that is only carried, null where none is."""
    keys = list(keys)
    backwards = periods.withColumn("__back", -F.unix_date(low))
    seen = along(backwards, Timeline(tuple(keys), ("__back",)), {"__next": previous(low)})
    end = F.coalesce(F.date_sub("__next", 1), F.greatest(F.col(high), until))
    longer = seen.withColumns({"carried_from": F.when(end > F.col(high), F.date_add(F.col(high), 1)), "__end": end})
    return longer.withColumn(high, F.col("__end")).drop("__back", "__next", "__end")


def on_days(days: DataFrame, periods: DataFrame, keys: Sequence[str], day: str, low: str, high: str, how: str = "left") -> DataFrame:
    """Days with the columns of the period that holds on them, bounds included. Disjoint periods give a day once.

    A period finds the days it holds on among those of its key, one sorted array, and meets them by key and day:
    what is shuffled is a row a period, a day, and a day held on. Without keys it is a band join.
    """
    keys, kept = list(keys), [c for c in periods.columns if c not in keys]
    if not keys:
        numbered = periods.withColumns({"__low": F.unix_date(low), "__high": F.unix_date(high)})
        return band_join(days, numbered, F.unix_date(F.col(day)), "__low", "__high", how).drop("__low", "__high")
    given = periods.filter(F.col(low) <= F.col(high)).join(_days(days, keys, day).hint("merge"), keys)
    before = count_upto(F.col("__days"), F.date_sub(F.col(low), 1))
    given = given.withColumns({"__before": before, "__upto": count_upto(F.col("__days"), F.col(high))})
    on = F.slice("__days", F.col("__before") + 1, F.col("__upto") - F.col("__before"))
    shown = given.select(*keys, *kept, F.explode(on).alias("__on")).alias("r")
    same = F.col(f"l.{day}") == F.col("r.__on")
    for key in keys:
        same = same & (F.col(f"l.{key}") == F.col(f"r.{key}"))
    met = days.alias("l").join(shown.hint("merge"), same, how)
    return met.select(*[F.col(f"l.`{c}`") for c in days.columns], *[F.col(f"r.`{c}`") for c in kept])
