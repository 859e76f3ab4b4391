"""Ordered-row operators that stay parallel inside one key.

A plain window puts every row of a key into one task. Here a key's rows are first cut
into *chunks*, ranges of the whole order. Each chunk is its own window group, and what
flows from one chunk to the next (the previous row, a running total, the last known
value) is computed on one summary row per chunk and enters the chunk as an extra edge
row. The rows themselves are shuffled once, by (keys, chunk), whatever the skew of the
keys.

``Timeline(chunk=ROWS)`` cuts keys with many rows at splitters (:func:`splitters`), which
are values of the whole order, so rows of one instant are cut too. A column cuts where
its value changes. ``chunk=None`` is the plain window, right when a key is bounded by
nature (one row per entity and day, say).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeops.functions.clock import epoch_seconds

CHUNK, _EDGE = "__chunk", "__edge"
_LEADING, _ROW, _TRAILING = 0, 1, 2


#: Rows of a key that a chunk is meant for.
ROWS = 262_144
#: One row in so many is looked at to draw splitters, fewer beyond MOST looked at; every STEP-th is a splitter.
RATE, MOST, STEP = 4_096, 2**24, 64


@dataclass(frozen=True)
class Timeline:
    """Rows of ``keys`` in ``order`` (a total order), cut by ``chunk``.

    ``chunk`` is a number of rows, or a column that doesn't decrease along the order and is equal
    for order peers.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    chunk: Column | int | None = None

    def cut(self, rows: DataFrame) -> DataFrame:
        """The rows with their chunk."""
        if not isinstance(self.chunk, int):
            return rows.withColumn(CHUNK, self.chunk)
        borders = splitters(rows, self.keys, self.order, self.chunk)
        at = _order_key((*self.keys, *self.order))
        placed = rows.withColumn("__borders", borders)
        reached = F.when(F.size("__borders") == 0, 0).otherwise(count_upto(F.col("__borders"), at))
        return placed.withColumn(CHUNK, reached.cast("long")).drop("__borders")

    def window(self, backwards: bool = False, leading: Sequence[str] = (), split: Sequence[str] = ()):
        """``backwards`` reads the same rows from the end. A frame that ends at unbounded
        following is evaluated anew for every row, which is quadratic; a running frame over
        the reversed order is not."""
        order = [*leading, *self.order]
        return Window.partitionBy(*self.keys, *split).orderBy(*[F.col(c).desc() for c in order] if backwards else order)


def every(column: str, seconds: int) -> Column:
    """Chunk by fixed slices of a timestamp."""
    return F.floor(epoch_seconds(F.col(column)) / seconds).cast("long")


def splitters(rows: DataFrame, keys: Sequence[str], order: Sequence[str], size: int = ROWS) -> Column:
    """The sorted values of (keys, order) to cut keys with more than about ``size`` rows at, as a scalar subquery.

    One row in RATE is looked at, or one in so many that about MOST are; which one, a hash of its order
    value says, so the same rows give the same splitters wherever the plan is run. There is a splitter
    every STEP rows of a key looked at and ``size`` rows or more: at most MOST / STEP altogether, whatever
    the table's size. Nothing runs before the plan does.
    """
    rate = max(1, min(RATE, size // STEP))
    total = rows.agg(F.count(F.lit(1))).scalar()
    share = F.greatest(F.lit(rate), F.ceil(total / MOST)).cast("long")
    by = [f"__k{i}" for i in range(len(keys))]
    names = [F.col(k).alias(name) for k, name in zip(keys, by, strict=True)]
    seen = rows.select(*names, _order_key(order).alias("__at"), _order_key((*keys, *order)).alias("__whole"))
    seen = seen.filter(F.pmod(F.xxhash64("__at"), share) == 0)
    nth = F.row_number().over(Window.partitionBy(*by).orderBy("__at"))
    drawn = seen.withColumn("__nth", nth).filter(F.col("__nth") % (size // rate) == 0)
    return drawn.agg(F.array_sort(F.collect_list("__whole"))).scalar()


def count_upto(borders: Column, at: Column) -> Column:
    """How many of the sorted borders are not beyond ``at``, by halving."""
    start = F.struct(F.lit(0).alias("low"), F.size(borders).alias("high"))

    def half(span: Column, _: Column) -> Column:
        middle = F.floor((span["low"] + span["high"]) / 2).cast("int")
        return F.when(F.get(borders, middle) <= at, F.struct((middle + 1).alias("low"), span["high"].alias("high"))).otherwise(
            F.struct(span["low"].alias("low"), middle.alias("high"))
        )

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(borders) + 1)).cast("int"))
    return F.aggregate(steps, start, half, lambda span: span["low"])


def every_number(column: str, width: float) -> Column:
    """Chunk by fixed slices of a number."""
    return F.floor(F.col(column) / width).cast("long")


@dataclass(frozen=True)
class Feature:
    """What a feature needs: its input per row, the chunk summary, the value handed to
    the next chunk, and the window expression that reads both. A trailing feature is handed
    over and read backwards."""

    source: Column
    summarise: Callable[[str, Column], Column]
    hand_over: Callable[[str, object], Column]
    read: Callable[[str, object], Column]
    edge: int = _LEADING


def _order_key(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def previous(column: str | Column, default=None) -> Feature:
    """OP-99/100: the value on the preceding row."""
    source = F.struct((F.col(column) if isinstance(column, str) else column).alias("v"))

    def read(name, window):
        earlier = F.lag(name).over(window)
        if default is None:
            return earlier["v"]
        return F.when(earlier.isNull(), F.lit(default)).otherwise(earlier["v"])

    return Feature(
        source=source,
        summarise=lambda name, order: F.max_by(F.col(name), order),
        hand_over=lambda name, chunks: F.lag(name).over(chunks),
        read=read,
    )


def running_total(value: str | Column, peers_share: bool = False) -> Feature:
    """OP-101/110: running sum; with ``peers_share`` rows of equal order show the same sum.

    Peers share a chunk, so the order has to name all of them alike. Where many rows are peers, sum them first and join the result back.
    """

    def read(name, window):
        frame = window.rangeBetween if peers_share else window.rowsBetween
        return F.sum(name).over(frame(Window.unboundedPreceding, Window.currentRow))

    return Feature(
        source=F.col(value) if isinstance(value, str) else value,
        summarise=lambda name, order: F.sum(name),
        hand_over=lambda name, chunks: F.sum(name).over(chunks.rowsBetween(Window.unboundedPreceding, -1)),
        read=read,
    )


def latest_maximum(column: str) -> Feature:
    """The largest value on the rows before this one."""
    before = (Window.unboundedPreceding, -1)
    return Feature(
        source=F.col(column),
        summarise=lambda name, order: F.max(name),
        hand_over=lambda name, chunks: F.max(name).over(chunks.rowsBetween(*before)),
        read=lambda name, window: F.max(name).over(window.rowsBetween(*before)),
    )


def position() -> Feature:
    """OP-98: row number."""
    return running_total(F.lit(1).cast("long"))


def last_known(column: str | Column) -> Feature:
    """OP-107: the latest non-null value up to this row."""
    source = F.col(column) if isinstance(column, str) else column
    return Feature(
        source=source,
        summarise=lambda name, order: F.max_by(F.col(name), F.when(F.col(name).isNotNull(), order)),
        hand_over=lambda name, chunks: F.last(name, ignorenulls=True).over(
            chunks.rowsBetween(Window.unboundedPreceding, -1)
        ),
        read=lambda name, window: F.last(name, ignorenulls=True).over(
            window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ),
    )


def next_known(column: str | Column) -> Feature:
    """OP-107: the earliest non-null value from this row on."""
    source = F.col(column) if isinstance(column, str) else column
    return Feature(
        source=source,
        summarise=lambda name, order: F.min_by(F.col(name), F.when(F.col(name).isNotNull(), order)),
        hand_over=lambda name, chunks: F.last(name, ignorenulls=True).over(
            chunks.rowsBetween(Window.unboundedPreceding, -1)
        ),
        read=lambda name, window: F.last(name, ignorenulls=True).over(
            window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ),
        edge=_TRAILING,
    )


def _names(features: Mapping[str, Feature]) -> dict[str, str]:
    return {out: f"__in_{i}" for i, out in enumerate(features)}


def along(df: DataFrame, timeline: Timeline, features: Mapping[str, Feature]) -> DataFrame:
    """Add one column per feature, all in a single pass over the timeline."""
    names = _names(features)
    columns = [c for c in df.columns if c not in features]
    rows = df.withColumns({names[out]: f.source for out, f in features.items()})
    if timeline.chunk is None:
        read = {out: f.read(names[out], timeline.window(f.edge == _TRAILING)) for out, f in features.items()}
        return rows.select(*columns, *[c.alias(out) for out, c in read.items()])

    rows = timeline.cut(rows)
    order = _order_key(timeline.order)
    summary = rows.groupBy(*timeline.keys, CHUNK).agg(
        *[f.summarise(names[out], order).alias(names[out]) for out, f in features.items()]
    )
    whole = Timeline(timeline.keys, (CHUNK,))
    handed = summary.select(
        *timeline.keys,
        CHUNK,
        *[f.hand_over(names[out], whole.window(f.edge == _TRAILING)).alias(names[out]) for out, f in features.items()],
    )
    sides = sorted({f.edge for f in features.values()})
    edges = handed.withColumn(_EDGE, F.explode(F.array(*[F.lit(side) for side in sides])))
    edges = edges.select(
        *timeline.keys,
        CHUNK,
        _EDGE,
        *[F.when(F.col(_EDGE) == f.edge, F.col(names[out])).alias(names[out]) for out, f in features.items()],
    ).filter(reduce(lambda x, y: x | y, [F.col(n).isNotNull() for n in names.values()]))
    merged = rows.withColumn(_EDGE, F.lit(_ROW)).unionByName(edges, allowMissingColumns=True)
    read = {
        out: f.read(names[out], timeline.window(f.edge == _TRAILING, [_EDGE], [CHUNK])) for out, f in features.items()
    }
    return (
        merged.select(*columns, _EDGE, *[c.alias(out) for out, c in read.items()])
        .filter(F.col(_EDGE) == _ROW)
        .drop(_EDGE)
    )


def with_runs(
    df: DataFrame,
    timeline: Timeline,
    run: str,
    compare: Sequence[str],
    breaks: Callable[[Callable[[str], Column], Callable[[str], Column]], Column],
) -> DataFrame:
    """OP-109/111: number the runs of a timeline.

    ``breaks(before, here)`` says whether a row starts a new run, given accessors for
    the ``compare`` columns of the previous and of this row. The first row always does;
    an unknown (null) answer starts a run too.
    """
    snapshot = F.struct(*[F.col(c).alias(c) for c in compare])

    def starts(earlier: Column, here: Column) -> Column:
        joined = F.coalesce(~breaks(lambda c: earlier[c], lambda c: here[c]), F.lit(False))
        return F.when(earlier.isNotNull() & joined, F.lit(0)).otherwise(F.lit(1)).cast("long")

    if timeline.chunk is None:
        window = timeline.window()
        return (
            df.withColumn("__snap", snapshot)
            .withColumn("__start", starts(F.lag("__snap").over(window), F.col("__snap")))
            .withColumn(run, F.sum("__start").over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .drop("__snap", "__start")
        )

    rows = timeline.cut(df).withColumn("__snap", snapshot)
    inside = Window.partitionBy(*timeline.keys, CHUNK).orderBy(*timeline.order)
    order = _order_key(timeline.order)
    narrow = rows.select(*dict.fromkeys([*timeline.keys, CHUNK, *timeline.order]), "__snap")
    narrow = narrow.withColumn("__earlier", F.lag("__snap").over(inside))
    summary = narrow.groupBy(*timeline.keys, CHUNK).agg(
        F.sum(F.when(F.col("__earlier").isNotNull(), starts(F.col("__earlier"), F.col("__snap")))).alias("inner"),
        F.min_by("__snap", order).alias("first"),
        F.max_by("__snap", order).alias("last"),
    )
    chunks = Window.partitionBy(*timeline.keys).orderBy(CHUNK)
    handed = (
        summary.withColumn("__snap", F.lag("last").over(chunks))
        .withColumn("total", F.coalesce("inner", F.lit(0)) + starts(F.col("__snap"), F.col("first")))
        .withColumn("__seed", F.sum("total").over(chunks.rowsBetween(Window.unboundedPreceding, -1)))
        .filter(F.col("__snap").isNotNull())
        .select(*timeline.keys, CHUNK, "__snap", "__seed", F.lit(_LEADING).alias(_EDGE))
    )
    merged = rows.withColumn(_EDGE, F.lit(_ROW)).unionByName(handed, allowMissingColumns=True)
    local = Window.partitionBy(*timeline.keys, CHUNK).orderBy(_EDGE, *timeline.order)
    numbered = merged.withColumn(
        "__start",
        F.when(F.col(_EDGE) == _LEADING, F.col("__seed")).otherwise(
            starts(F.lag("__snap").over(local), F.col("__snap"))
        ),
    ).withColumn(run, F.sum("__start").over(local.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.filter(F.col(_EDGE) == _ROW).drop(_EDGE, CHUNK, "__snap", "__seed", "__start")


def fill_both_ways(df: DataFrame, timeline: Timeline, column: str, out: str | None = None) -> DataFrame:
    """OP-107: forward fill, then backward fill what is left."""
    filled = along(df, timeline, {"__back": last_known(column), "__ahead": next_known(column)})
    return filled.withColumn(out or column, F.coalesce("__back", "__ahead")).drop("__back", "__ahead")


def fill_agreeing_gaps(
    df: DataFrame, timeline: Timeline, column: str, gap: Column, accept: Column | None = None, out: str | None = None
) -> DataFrame:
    """OP-108: rows marked ``gap`` take the value both neighbours agree on (if ``accept``)."""
    known = F.when(gap, F.lit(None)).otherwise(F.col(column))
    filled = along(df, timeline, {"__back": last_known(known), "__ahead": next_known(known)})
    agree = F.col("__back") == F.col("__ahead")
    if accept is not None:
        agree = agree & accept
    return filled.withColumn(out or column, F.when(agree, F.col("__back")).otherwise(F.col(column))).drop(
        "__back", "__ahead"
    )


def calendar_flag_nearby(day: str, column: str, before: int, after: int) -> Column:
    """OP-104: any flag within ``before``/``after`` rows. For one-row-per-day calendars."""
    frame = Window.orderBy(day).rowsBetween(-before, after)
    return F.when(F.sum(column).over(frame) > 0, 1).otherwise(0)


def calendar_flag_recent(day: str, column: str, before: int) -> Column:
    """OP-105: flagged in the last ``before`` rows but not on this one."""
    frame = Window.orderBy(day).rowsBetween(-before, 0)
    return F.when((F.sum(column).over(frame) > 0) & (F.col(column) == 0), 1).otherwise(0)


def rolling_sum(value: str, keys: Sequence[str], order: Sequence[str], rows: int) -> Column:
    """OP-106: sum of the last ``rows`` rows of a short per-key series."""
    return F.sum(value).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(-(rows - 1), 0))


def to_date_sum(value: str, keys: Sequence[str], order: Sequence[str]) -> Column:
    """OP-106: running sum within ``keys`` (a year, say) of a short per-key series."""
    return F.sum(value).over(
        Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
