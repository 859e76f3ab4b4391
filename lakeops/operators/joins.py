"""Joins Spark has no single operator for.

Spark broadcasts a side whose size it has checked against ``spark.sql.autoBroadcastJoinThreshold``
and sort-merges otherwise, where adaptive execution splits skewed keys. Only :func:`band_join` says
which, as Spark takes the rows it makes for fewer than they are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakeops.functions.clock import epoch_micros
from lakeops.operators.timeline import ROWS, Timeline, along, last_known, next_known, running_total


def clean_key(column: Column, kind: str | None = None) -> Column:
    """OP-73: trim text keys and align their type before an equi join."""
    return F.trim(column) if kind is None else F.trim(column.cast("string")).try_cast(kind)


def band_join(
    facts: DataFrame,
    bands: DataFrame,
    value: Column,
    low: str,
    high: str,
    how: str = "left",
    keys: Sequence[str] = (),
    few: bool = False,
) -> DataFrame:
    """OP-74: ``value BETWEEN low AND high`` as an equi join over power-of-two cells.

    A band lies on the level whose cells are at least as long as itself, so it touches one or two
    of them, however long it is; a fact probes one cell on each level that some band lies on. The
    exact predicate decides afterwards. Both bounds are inclusive, so touching bands both match; a
    null bound, or a low above its high, matches nothing. ``how`` is inner or left.

    The sides are sorted and merged: Spark's estimate leaves out that a fact is repeated per level, so it
    would broadcast facts of any number from small files. ``few`` bands, as rules are, are broadcast
    unless broadcasts are off.
    """
    off = facts.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith(("-", "0"))
    length = F.col(high).cast("double") - F.col(low).cast("double")
    # The lengths of bands that are one point long say nothing about a level; any will do.
    level = F.when(length > 0, F.ceil(F.log2(length))).otherwise(0).cast("int")
    cell = lambda at, size: F.floor(at.cast("double") / F.pow(F.lit(2.0), size)).cast("long")
    leveled = bands.filter(F.col(low) <= F.col(high)).withColumn("__level", level)
    ends = F.array_distinct(F.array(cell(F.col(low), F.col("__level")), cell(F.col(high), F.col("__level"))))
    # The end cells are neighbours or the same.
    right = leveled.withColumn("__cell", F.explode(ends)).alias("r")
    levels = leveled.agg(F.collect_set("__level")).scalar()
    probed = facts.withColumns({"__value": value, "__levels": levels}).withColumn("__level", F.explode("__levels"))
    left = probed.withColumn("__cell", cell(F.col("__value"), F.col("__level"))).alias("l")
    on = (F.col("l.__level") == F.col("r.__level")) & (F.col("l.__cell") == F.col("r.__cell"))
    on = on & F.col("l.__value").between(F.col(f"r.{low}"), F.col(f"r.{high}"))
    for key in keys:
        on = on & (F.col(f"l.{key}") == F.col(f"r.{key}"))
    kept = [c for c in bands.columns if c not in keys]
    joined = left.join(right.hint("broadcast" if few and not off else "merge"), on)
    out = joined.select(*[F.col(f"l.`{c}`") for c in facts.columns], *[F.col(f"r.`{c}`") for c in kept])
    if how == "inner":
        return out
    # A fact has a band if another one with its keys and value has.
    found = joined.select(*[F.col(f"l.`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)], F.col("l.__value").alias("__found")).distinct()
    valued = facts.withColumn("__value", value)
    same = valued["__value"] == found["__found"]
    for i, key in enumerate(keys):
        same = same & (valued[key] == found[f"__k{i}"])
    alone = valued.join(found, same, "left_anti").select(
        *[F.col(f"`{c}`") for c in facts.columns], *[F.lit(None).cast(bands.schema[c].dataType).alias(c) for c in kept]
    )
    return out.unionAll(alone)


def nearest_event(
    subjects: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    subject_time: str,
    event_time: str,
    event_order: Sequence[str],
    payload: Sequence[str],
    back_s: float,
    ahead_s: float,
    ahead_weight: int = 10,
    chunk_rows: int = ROWS,
) -> DataFrame:
    """OP-76: the cheapest event around each subject row; rows without one are kept.

    An event up to ``back_s`` earlier (open bound) costs its distance, one up to
    ``ahead_s`` later costs ``ahead_weight`` times its distance. On each side the cost
    grows with the distance, so the winner is the last event before or the first event
    after: two fills along the merged timeline, never a pair per candidate. Equal cost
    takes the earlier event; events at one instant take the first in ``event_order``.
    Keys are cut into chunks of about ``chunk_rows`` rows, also where many subjects fall on
    one instant.
    """
    at = "__at"
    # Keys and times compare as in SQL: a null matches nothing.
    marks = events.dropna(subset=[*keys, event_time]).select(
        *keys,
        F.col(event_time).alias(at),
        F.struct(
            F.col(event_time).alias("__event_at"), *[F.col(c) for c in dict.fromkeys([*event_order, *payload])]
        ).alias("__event"),
    )
    # One event per instant decides ties before the fill.
    marks = (
        marks.groupBy(*keys, at)
        .agg(F.min_by("__event", F.struct(*[F.col(f"__event.{c}") for c in event_order])).alias("__event"))
        .withColumn("__kind", F.lit(0))
    )
    rows = subjects.withColumn(at, F.col(subject_time)).withColumn("__kind", F.lit(1))
    merged = rows.unionByName(marks, allowMissingColumns=True)
    # __kind 0 sorts events before subjects of the same instant: distance 0 counts as "back". The order of
    # subjects of one instant doesn't matter, a hash of the row lets them be cut.
    merged = merged.withColumn("__tie", F.xxhash64(*subjects.columns))
    line = Timeline(tuple(keys), (at, "__kind", "__tie"), chunk_rows)
    seen = along(merged, line, {"__back": last_known("__event"), "__ahead": next_known("__event")})
    seen = seen.filter(F.col("__kind") == 1)

    def micros(column):
        return epoch_micros(F.col(column))

    gap_back = micros(at) - micros("__back.__event_at")
    gap_ahead = micros("__ahead.__event_at") - micros(at)
    cost_back = F.when(gap_back < int(back_s * 1e6), gap_back)
    cost_ahead = F.when(gap_ahead < int(ahead_s * 1e6), gap_ahead * ahead_weight)
    take_back = cost_back.isNotNull() & (cost_ahead.isNull() | (cost_back <= cost_ahead))
    choice = F.when(take_back, F.col("__back")).when(cost_ahead.isNotNull(), F.col("__ahead"))
    return seen.withColumn("__choice", choice).select(
        *subjects.columns, *[F.col(f"__choice.{c}").alias(c) for c in payload], F.col("__choice.__event_at").alias("event_at")
    )


def count_in_ranges(
    spans: DataFrame,
    points: DataFrame,
    keys: Sequence[str],
    span_id: str,
    low: str,
    high: str,
    at: str,
    out: str,
    chunk_rows: int = ROWS,
) -> DataFrame:
    """Number of points of the same key within each ``[low, high]`` span, both ends included.

    The count is the difference of two running totals on the merged timeline, so its cost
    is the rows, never the pairs: right for big spans over big, skewed keys. Keys are cut into
    chunks of about ``chunk_rows`` rows, also where many points fall on one instant.
    """
    # Among equal instants a span opens before the points and closes after them, so points of one
    # instant may come in any order and be cut apart.
    ends = F.array(
        F.struct(F.col(low).alias("__at"), F.lit(0).alias("__kind")),
        F.struct(F.col(high).alias("__at"), F.lit(2).alias("__kind")),
    )
    sides = spans.select(*keys, F.col(span_id).alias("__id"), F.explode(ends).alias("__end")).select(
        *keys, "__id", "__end.*"
    )
    marks = points.dropna(subset=[*keys, at]).select(
        *keys, F.col(at).alias("__at"), F.lit(1).alias("__kind"), F.lit(1).alias("__one"), F.xxhash64(*points.columns).alias("__tie")
    )
    merged = sides.withColumn("__tie", F.xxhash64("__id")).unionByName(marks, allowMissingColumns=True)
    line = Timeline(tuple(keys), ("__at", "__kind", "__tie"), chunk_rows)
    counted = along(merged, line, {"__upto": running_total(F.coalesce("__one", F.lit(0)))})
    sign = F.when(F.col("__kind") == 2, 1).otherwise(-1)
    totals = counted.filter(F.col("__kind") != 1).groupBy("__id").agg(F.sum(F.col("__upto") * sign).alias(out))
    return spans.join(totals, F.col(span_id) == F.col("__id"), "left").drop("__id")


def either_key_join(
    left: DataFrame, right: DataFrame, left_key: str, right_keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """OP-75: match when ``left_key`` equals any of ``right_keys``; a pair appears once.

    The right side is listed once per distinct key value it can match, so the OR is one
    equi join. Key values repeated within a right row are listed once.
    """
    listed = right.withColumn(
        "__key", F.explode(F.array_compact(F.array_distinct(F.array(*[F.col(k) for k in right_keys]))))
    )
    return left.join(listed, left[left_key] == F.col("__key"), how).drop("__key")


def by_source_join(
    left: DataFrame,
    right: DataFrame,
    source: str,
    left_key: str,
    right_key_of_source: Mapping[str, str],
    how: str = "left",
) -> DataFrame:
    """OP-75, by source: ``source`` decides which right column the key is compared with."""
    pairs = F.array(
        *[F.struct(F.lit(s).alias("s"), F.col(k).alias("k")) for s, k in right_key_of_source.items()]
    )
    listed = right.withColumn("__pair", F.explode(pairs))
    on = (left[source] == F.col("__pair.s")) & (left[left_key] == F.col("__pair.k"))
    return left.join(listed, on, how).drop("__pair")


def rule_filter(
    df: DataFrame, rules: DataFrame, columns: Sequence[str], exclude: bool = False
) -> DataFrame:
    """OP-53: keep (or drop) the combinations listed in a rules table."""
    return df.join(rules.select(*columns).distinct(), list(columns), "left_anti" if exclude else "left_semi")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """OP-31/47/81/82: the row with the greatest ``order`` per key.

    An aggregate with map-side combine, not a window: a hot key never sits in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    best = df.groupBy(*keys).agg(F.max_by(row, F.struct(*[F.col(c) for c in order])).alias("__row"))
    return best.select(*keys, *[F.col(f"__row.`{c}`").alias(c) for c in rest]).select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """OP-47/82/98: the row with the smallest ``order`` per key."""
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    best = df.groupBy(*keys).agg(F.min_by(row, F.struct(*[F.col(c) for c in order])).alias("__row"))
    return best.select(*keys, *[F.col(f"__row.`{c}`").alias(c) for c in rest]).select(*df.columns)


def latest_versions(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """OP-81 with ties kept: every row whose version is the greatest of its key."""
    top = df.groupBy(*keys).agg(F.max(version).alias(version))
    return df.join(top, [*keys, version], "left_semi")


def with_count(left: DataFrame, right: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """OP-84: number of right rows per left row, 0 when there is none."""
    counts = right.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
    return left.join(counts, list(keys), "left").withColumn(out, F.coalesce(out, F.lit(0)))


def join_back(df: DataFrame, keys: Sequence[str], **aggregates: Column) -> DataFrame:
    """OP-78/102/103/112: per-key aggregates on every row.

    Aggregate and join instead of a full-partition window, so no key is gathered in one
    task. Null keys form a group of their own.
    """
    per_key = df.groupBy(*[F.col(k).alias(f"__k_{k}") for k in keys]).agg(*[c.alias(n) for n, c in aggregates.items()])
    on = None
    for k in keys:
        one = df[k].eqNullSafe(per_key[f"__k_{k}"])
        on = one if on is None else on & one
    return df.join(per_key, on, "left").drop(*[f"__k_{k}" for k in keys])


def translate(
    df: DataFrame, translations: DataFrame, table: str, language: str, key: str, out: str
) -> DataFrame:
    """OP-83: a label from a shared translation table for one table and language."""
    wanted = translations.filter((F.col("table_name") == table) & (F.col("lang") == language)).select(
        F.col("object_id").alias("__id"), F.col("text").alias(out)
    )
    return df.join(wanted, df[key] == F.col("__id"), "left").drop("__id")
