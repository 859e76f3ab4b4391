"""Aggregations: shares, rates, quantiles, ordered text, flat extracts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeops.operators.timeline import CHUNK, ROWS, Timeline



def conditional_counts(conditions: Mapping[str, Column]) -> list[Column]:
    """OP-89: one conditional count per entry."""
    return [F.sum(F.when(c, 1).otherwise(0)).alias(name) for name, c in conditions.items()]


def shares_within(df: DataFrame, categories: Mapping[str, Sequence[str]], prefix: str = "part_") -> DataFrame:
    """OP-89: each column's share of its category total; an empty category gives null."""
    shares = {}
    for members in categories.values():
        total = reduce(lambda a, b: a + b, [F.col(m) for m in members])
        for m in members:
            shares[f"{prefix}{m}"] = F.try_divide(F.col(m), total)
    return df.withColumns(shares)


def rate(part: Column, whole: Column) -> Column:
    """OP-90: ratio of two sums; null when the base is empty."""
    return F.try_divide(F.sum(part).cast("double"), F.sum(whole).cast("double"))


def exact_quantiles(
    df: DataFrame, value: str, probabilities: Mapping[str, str], groups: Sequence[str] = (), slots: int = 16_384, levels: int = 1
) -> DataFrame:
    """OP-91/154: discrete quantiles, exact at any group size.

    Values are counted in ``slots`` slots between the smallest and the largest value, one row per group and
    slot after the map-side combine, which finds the slot of each wanted rank; its values are
    counted again in slots between its own smallest and largest value, and so on. So a level ranks
    ``slots`` rows a group and quantile at most, whatever the values; far outliers cost one level. The distinct
    values of the last slots, which some 270 million cells don't tell apart, are ranked one by one; give
    more ``levels`` where a few outliers hide others. No group's values are ever gathered, and nothing runs
    before the plan does. Probabilities are decimal text, so ranks carry no rounding.
    """
    groups = list(groups)
    place = lambda low, high: F.coalesce(F.floor(F.try_divide(F.col("__x") - low, high - low) * slots), F.lit(0)).cast("long")
    values = df.filter(F.col(value).isNotNull()).select(*groups, F.col(value).alias("__v"), F.col(value).cast("double").alias("__x"))
    ends = [values.agg(f("__x")).scalar() for f in (F.min, F.max)]
    rows = values.withColumn("__slot", place(*ends))
    wanted = F.explode(
        F.array(
            *[
                F.struct(F.lit(name).alias("name"), F.lit(Decimal(p)).cast("decimal(20,10)").alias("p"))
                for name, p in probabilities.items()
            ]
        )
    )
    totals = F.sum("n").over(Window.partitionBy(*groups))
    first = _slot_counts(rows, [*groups, "__slot"], groups).withColumn("total", totals).withColumn("__q", wanted)
    ranked = first.select("*", F.col("__q.name").alias("__name"), F.greatest(F.lit(1), F.ceil(F.col("__q.p") * F.col("total"))).cast("long").alias("rank"))
    named = [*groups, "__name"]
    for level in range(levels + 1):
        # Where the wanted ranks are: the first slot, and the smallest and largest value of the last one.
        targets = ranked.filter(_HIT).select(
            *[F.col(c).alias(f"__t{i}") for i, c in enumerate((*groups, "__slot" if level == 0 else "__first"))],
            "__name", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"), "low", "high",
        )
        # Each level reads the values anew, not what the levels before have joined.
        inside = lambda low, high: F.col("__x").between(low, high)
        if groups:
            on = reduce(lambda x, y: x & y, [rows[c].eqNullSafe(targets[f"__t{i}"]) for i, c in enumerate((*groups, "__slot"))])
            met = rows.join(targets, on & inside(F.col("low"), F.col("high")))
        else:
            # A target a quantile, as a scalar subquery.
            listed = targets.agg(F.collect_list(F.struct("__t0", "__name", "rank", "low", "high"))).scalar()
            hits = F.filter("__all", lambda t: (t["__t0"] == F.col("__slot")) & inside(t["low"], t["high"]))
            met = rows.withColumn("__all", listed).withColumn("__hit", F.explode(hits)).select(*rows.columns, "__hit.*")
        met = met.select(*[rows[c] for c in groups], "__name", "rank", F.col("__slot").alias("__first"), "__v", "__x", "low", "high")
        if level < levels:
            ranked = _slot_counts(met.withColumn("__slot", place(F.col("low"), F.col("high"))), [*named, "rank", "__first", "__slot"], named)
    last = met.groupBy(*named, "rank", "__v").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(*named).orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = last.withColumn("upto", F.sum("n").over(before))
    return ranked.filter(_HIT).groupBy(*groups).agg(
        *[F.max(F.when(F.col("__name") == name, F.col("__v"))).alias(name) for name in probabilities]
    )


_HIT = "upto >= rank AND upto - n < rank"


def _slot_counts(rows: DataFrame, keys: Sequence[str], within: Sequence[str]) -> DataFrame:
    """Rows per slot, their smallest and largest value, and the rows up to the slot."""
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("__x").alias("low"), F.max("__x").alias("high"))
    before = Window.partitionBy(*within).orderBy("__slot").rowsBetween(Window.unboundedPreceding, 0)
    return counted.withColumn("upto", F.sum("n").over(before))


def flag_above_quantile(df: DataFrame, value: str, probability: str, out: str) -> DataFrame:
    """OP-154: 0/1 flag for values at or above a global quantile."""
    bound = exact_quantiles(df, value, {"__bound": probability})
    return df.withColumn(out, F.when(F.col(value) >= bound.scalar(), 1).otherwise(0))


def calendar_quantile(calendar: DataFrame, value: str, probability: str) -> Column:
    """OP-154 on a one-row-per-day frame: the discrete quantile as a scalar subquery."""
    bound = calendar.agg(F.expr(f"percentile_disc({Decimal(probability)}) WITHIN GROUP (ORDER BY `{value}`)"))
    return bound.scalar()


def approximate_quantiles(value: str, probabilities: Mapping[str, float], accuracy: int = 10000) -> list[Column]:
    """OP-91, sketch form: one bounded sketch per group."""
    return [F.percentile_approx(value, p, accuracy).alias(name) for name, p in probabilities.items()]


def ordered_text(df: DataFrame, keys: Sequence[str], value: str, out: str, separator: str = ",", size: int = ROWS) -> DataFrame:
    """OP-95: distinct values of a key joined in order.

    Duplicates are removed first. A key with very many values is cut at splitters of the values; each part is joined by
    itself and the parts are joined in order, so what meets in one task is the text of the result.
    """
    distinct = df.filter(F.col(value).isNotNull()).select(*keys, value).distinct()
    parts = Timeline(tuple(keys), (value,), size).cut(distinct).groupBy(*keys, CHUNK).agg(
        F.array_join(F.array_sort(F.collect_list(value)), separator).alias("__text")
    )
    whole = F.transform(F.array_sort(F.collect_list(F.struct(CHUNK, "__text"))), lambda part: part["__text"])
    return parts.groupBy(*keys).agg(F.array_join(whole, separator).alias(out))


def distinct_counts(df: DataFrame, keys: Sequence[str], **columns: str) -> DataFrame:
    """OP-88/103: distinct counts by two-level aggregation, never a set per key."""
    parts = []
    for out, column in columns.items():
        pairs = df.select(*keys, column).filter(F.col(column).isNotNull()).distinct()
        parts.append(pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)))
    return reduce(lambda a, b: a.join(b, list(keys), "full"), parts).fillna(0, list(columns))


def first_values(df: DataFrame, column: str, n: int, descending: bool = False) -> DataFrame:
    """OP-96: the first ``n`` distinct values in order."""
    distinct = df.select(column).distinct()
    return distinct.orderBy(F.col(column).desc() if descending else F.col(column).asc()).limit(n)


def with_catch_all(df: DataFrame, key: str, member: Mapping[str, object]) -> DataFrame:
    """OP-97: one extra "all" row per key value, so a filter on any period finds a row."""
    extra = df.select(key).distinct().withColumns(
        {c: F.lit(member.get(c)).cast(df.schema[c].dataType) for c in df.columns if c != key}
    )
    return df.unionByName(extra)
