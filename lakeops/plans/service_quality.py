"""Headway and punctuality indicators (MART-04..10).

Passages are rows of (day, line, stop, trip, planned second, deviation in seconds).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeops.functions.coding import flag
from lakeops.operators.joins import band_join, first_per_key, join_back, rule_filter
from lakeops.operators.summaries import rate
from lakeops.operators.timeline import Timeline, along, position, previous


def with_band(passages: DataFrame, bands: DataFrame, second_of_day: Column) -> DataFrame:
    """OP-74: hour band(s) of each passage."""
    return band_join(passages, bands, second_of_day, "band_from", "band_to", how="inner", few=True)


def band_table(slices: DataFrame, segments: DataFrame, bridge: DataFrame, bands: DataFrame) -> DataFrame:
    """The bands of a time slice, reached over its segments."""
    return (
        bridge.join(slices, "slice").join(segments, "segment").join(bands, "band").select("slice", "band", "band_from", "band_to")
    )


def headways(
    passages: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    planned_s: str,
    deviation_s: str,
    tolerance_s: int = 180,
    absolute: bool = True,
    inclusive: bool = False,
    chunk: Column | int | None = None,
) -> DataFrame:
    """MART-04: planned and actual time since the previous passage, and whether the actual
    one stays below the planned one plus a tolerance.

    ``counted`` is 1 where there is a previous passage. ``inclusive`` compares with ``<=``
    and ``absolute=False`` keeps the sign of bunched passages.
    """
    rows = passages.withColumn("actual_s", F.col(planned_s) + F.col(deviation_s))
    line = Timeline(tuple(keys), tuple(order), chunk)
    rows = along(rows, line, {"__before": previous(F.struct(F.col(planned_s).alias("planned"), F.col("actual_s").alias("actual")))})
    planned = F.col(planned_s) - F.col("__before.planned")
    actual = F.col("actual_s") - F.col("__before.actual")
    measured = F.abs(actual) if absolute else actual
    limit = planned + tolerance_s
    return rows.withColumns(
        {
            "planned_headway": planned,
            "actual_headway": actual,
            "regular": flag(measured <= limit if inclusive else measured < limit),
            "counted": flag(F.col("__before").isNotNull()),
        }
    ).drop("__before")


def headway_rollup(rows: DataFrame, keys: Sequence[str], terminals: DataFrame | None = None,
                   terminal_keys: Sequence[str] = ("line", "stop")) -> DataFrame:
    """MART-05: regular and counted passages and their ratio; terminal stops left out."""
    kept = rows if terminals is None else rule_filter(rows, terminals, terminal_keys, exclude=True)
    return kept.groupBy(*keys).agg(
        F.sum("regular").alias("regular"),
        F.sum("counted").alias("counted"),
        rate(F.col("regular"), F.col("counted")).alias("regularity"),
    )


def tolerance_headways(
    passages: DataFrame, keys: Sequence[str], order: Sequence[str], planned_s: str, deviation_s: str,
    tolerances: Sequence[int] = (59, 119), chunk: Column | int | None = None,
) -> DataFrame:
    """MART-09: one regularity flag per tolerance and the absolute headway difference."""
    rows = headways(passages, keys, order, planned_s, deviation_s, chunk=chunk)
    limits: Mapping[str, Column] = {
        f"regular_{t}": flag(F.col("actual_headway") <= F.col("planned_headway") + t) for t in tolerances
    }
    return rows.withColumns(
        {**limits, "headway_gap": F.abs(F.col("actual_headway") - F.col("planned_headway"))}
    ).drop("regular")


def chain_sizes(passages: DataFrame, chain: Sequence[str], stop: str) -> DataFrame:
    """Distinct stops per chain."""
    distinct = passages.select(*chain, stop).distinct()
    return distinct.groupBy(*chain).agg(F.count(stop).alias("chain_stops"))


def punctuality(
    passages: DataFrame,
    trip: Sequence[str],
    order: Sequence[str],
    chain: Sequence[str],
    stop: str,
    deviation_s: str,
    early_s: int = -59,
    late_s: int = 239,
    tail: int = 2,
    allowed: Column | None = None,
    chunk: Column | int | None = None,
) -> DataFrame:
    """MART-07: on time within [early, late]; a reference passage when its rank in the trip
    is at most the chain's distinct stops less ``tail``."""
    ranked = along(passages, Timeline(tuple(trip), tuple(order), chunk), {"rank_in_trip": position()})
    sizes = chain_sizes(passages, chain, stop)
    on_time = F.col(deviation_s).between(early_s, late_s)
    if allowed is not None:
        on_time = on_time & allowed
    return (
        ranked.join(sizes, list(chain), "left")
        .withColumn("on_time", flag(on_time))
        .withColumn("is_reference", flag(F.col("rank_in_trip") <= F.col("chain_stops") - tail))
        .withColumn("on_time_reference", F.when(F.col("is_reference") > 0, F.col("on_time")).otherwise(0))
    )


def terminus_punctuality(
    passages: DataFrame, trip: Sequence[str], order: Sequence[str], deviation_s: str,
    early_s: int = -59, late_s: int = 179,
) -> DataFrame:
    """MART-08: first passage of each trip only."""
    return first_per_key(passages, trip, order).withColumn(
        "on_time", flag(F.col(deviation_s).between(early_s, late_s))
    )


def monitored_punctuality(
    passages: DataFrame, rules: DataFrame, rule_columns: Sequence[str], deviation_s: str, keys: Sequence[str],
    early_s: int = -59, late_s: int = 179,
) -> DataFrame:
    """MART-10: punctuality at the monitored (line, direction, stop) combinations."""
    kept = rule_filter(passages, rules, rule_columns)
    flagged = kept.withColumn("on_time", flag(F.col(deviation_s).between(early_s, late_s)))
    return flagged.groupBy(*keys).agg(
        F.sum("on_time").alias("on_time"),
        F.count(F.lit(1)).alias("passages"),
        rate(F.col("on_time"), F.lit(1)).alias("punctuality"),
    )


def without_tail(points: DataFrame, chain: Sequence[str], order: Sequence[str], tail: int = 2,
                 chunk: Column | int | None = None) -> DataFrame:
    """MART-06: chain points less the last ``tail`` of each chain, with their rank and the
    chain's size."""
    ranked = along(points, Timeline(tuple(chain), tuple(order), chunk), {"rank": position()})
    if chunk is None:
        sized = ranked.withColumn("points_in_chain", F.count(F.lit(1)).over(Window.partitionBy(*chain)))
    else:
        sized = join_back(ranked, chain, points_in_chain=F.count(F.lit(1)))
    return sized.filter(F.col("rank") <= F.col("points_in_chain") - tail)
