"""Validation marts (MART-01..03, 22..24)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakeops.functions.clock import epoch_micros, operating_day
from lakeops.operators.joins import by_source_join, first_per_key, nearest_event


def star(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str]], how: str = "left") -> DataFrame:
    """OP-69/71: a fact with its dimensions, each given as (dim, fact key, dim key)."""
    out = fact
    for dim, fact_key, dim_key in dims:
        out = out.join(dim, F.col(fact_key) == F.col(dim_key), how)
    return out


def validations_by(
    fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str]], accepted: Column, keys: Mapping[str, Column]
) -> DataFrame:
    """MART-01: accepted validations counted by derived keys."""
    joined = star(fact, dims).filter(accepted)
    return joined.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(F.count(F.lit(1)).alias("validations"))


def validation_detail(validations: DataFrame, at: str, codes: Mapping[str, Column], cutoff_hour: int = 4) -> DataFrame:
    """MART-03: one row per validation with its operating day and coded attributes."""
    return validations.withColumns({"operating_day": operating_day(F.col(at), cutoff_hour), **codes})


def boarding_stops(
    validations: DataFrame,
    vehicles: DataFrame,
    passages: DataFrame,
    key_of_source: Mapping[str, str],
    payload: Sequence[str],
    back_s: int = 120,
    ahead_s: int = 1200,
    ahead_weight: int = 10,
) -> DataFrame:
    """MART-23: the vehicle by source-dependent code, then its nearest passage.

    A code that is listed for several vehicles gives one row a validation all the same: the vehicle whose passage
    costs least, then the earliest passage, then the smallest fleet code. Validations repeated in full give a row each.
    """
    columns = validations.columns
    counted = validations.groupBy(*columns).agg(F.count(F.lit(1)).alias("__times"))
    known = by_source_join(counted, vehicles, "source", "vehicle_code", key_of_source)
    known = known.select(*columns, "__times", "fleet_code").distinct()
    found = nearest_event(
        known, passages, ["fleet_code"], "validated_at", "arrived_at", ["arrived_at", "passage_id"], payload, back_s, ahead_s, ahead_weight
    )
    gap = epoch_micros(F.col("validated_at")) - epoch_micros(F.col("event_at"))
    cost = F.when(gap >= 0, gap).otherwise(-ahead_weight * gap)
    rated = found.withColumns({"__none": F.col("event_at").isNull(), "__cost": cost})
    best = first_per_key(rated, [*columns, "__times"], ["__none", "__cost", "event_at", "fleet_code"]).drop("__none", "__cost")
    return best.withColumn("__nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__times")))).drop("__nth", "__times")


def daily_counts(validations: DataFrame, day: Column, card: str) -> DataFrame:
    """MART-24: validations and distinct cards per day, in two aggregation levels."""
    pairs = validations.groupBy(day.alias("day"), card).agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy("day").agg(F.sum("n").alias("validations"), F.count(card).alias("cards"))


def yearly(validations: DataFrame, calendar: DataFrame, day: str) -> DataFrame:
    """MART-22: validations per year through the calendar. Counted per day before the join."""
    per_day = validations.groupBy(day).agg(F.count(F.lit(1)).alias("n"))
    return per_day.join(calendar, day, "left").groupBy("year").agg(F.sum("n").alias("validations"))
