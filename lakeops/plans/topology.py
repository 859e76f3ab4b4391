"""Line topology (MART-11..15)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeops.operators.joins import join_back
from lakeops.operators.reshape import union_distinct
from lakeops.operators.timeline import Timeline, along, previous, running_total


def with_previous(points: DataFrame, chain: Sequence[str], order: str, point: str, chunk: Column | int | None = None) -> DataFrame:
    """MART-12/13: the point before each one of its chain; 0 for the first."""
    return along(points, Timeline(tuple(chain), (order,), chunk), {"previous_point": previous(point, default=0)})


def chain_topology(
    points: DataFrame,
    distances: DataFrame,
    chain: Sequence[str],
    order: str,
    point: str,
    period: Sequence[str] = (),
    chunk: Column | int | None = None,
) -> DataFrame:
    """MART-12: previous point, distance from it, cumulative distance and point counts.

    ``distances`` has (from_point, to_point, distance), one row per pair. The first point's
    predecessor is 0. A chain's points are unique per position, so without ``chunk`` a
    chain is a window group of its own.
    """
    line = Timeline(tuple(chain), (order,), chunk)
    linked = with_previous(points, chain, order, point, chunk)
    measured = (
        linked.join(
            distances,
            (F.col("previous_point") == F.col("from_point")) & (F.col(point) == F.col("to_point")),
            "left",
        )
        .withColumn("leg", F.col("distance"))
        .drop("from_point", "to_point", "distance")
    )
    summed = along(measured, line, {"__upto": running_total("leg", peers_share=True)})
    if chunk is None:
        whole = Window.partitionBy(*chain)
        counted = summed.withColumn("points_in_chain", F.count(point).over(whole))
    else:
        counted = join_back(summed, chain, points_in_chain=F.count(point))
    if period:
        sizes = points.groupBy(*period).agg(F.count(point).alias("points_in_period"))
        counted = counted.join(sizes, list(period), "left")
    return counted.withColumns(
        {"leg": F.coalesce("leg", F.lit(0)), "distance_so_far": F.coalesce("__upto", F.lit(0))}
    ).drop("__upto")


def termini(topology: DataFrame, chain: Sequence[str], point: str, order: str, size: str) -> DataFrame:
    """MART-11: first and last point of each chain."""
    ends = topology.filter((F.col(order) == 1) | (F.col(order) == F.col(size)))
    return ends.select(*chain, point, F.col(order).alias("position")).distinct()


def located_topology(
    topology: DataFrame, places: DataFrame, point: str, patterns: Sequence[tuple[str, str]], label: str, out: str
) -> DataFrame:
    """MART-13: coordinates of the points and a line code from LIKE patterns on a label."""
    code = None
    for pattern, value in patterns:
        code = F.when(F.col(label).like(pattern), value) if code is None else code.when(F.col(label).like(pattern), value)
    return topology.join(places, point, "left").withColumn(out, code)


def valid_period(periods: DataFrame, day: Column, first: str, last: str, period: str) -> Column:
    """OP-80: the period valid on a day, as a scalar."""
    return periods.filter((F.col(first) <= day) & (F.col(last) >= day)).agg(F.max(period).alias(period)).scalar()


def in_latest_period(df: DataFrame, periods: DataFrame, period: str) -> DataFrame:
    """OP-80: rows of the latest period of a reference table."""
    return df.filter(F.col(period) == periods.agg(F.max(period)).scalar())


def line_reference(planned: Sequence[DataFrame], gis: DataFrame, ticketing: DataFrame, number: str) -> DataFrame:
    """MART-15: lines of several planning systems with their GIS and ticketing codes."""
    parts = [
        p.join(gis, p[number] == gis["gis_number"], "left").join(ticketing, p[number] == ticketing["ticket_number"], "left")
        for p in planned
    ]
    return union_distinct(parts)
