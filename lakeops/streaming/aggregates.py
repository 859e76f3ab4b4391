"""Event-time aggregation (OP-133/134/135)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _event_time(df: DataFrame, time: str, watermark: str | None) -> DataFrame:
    if not df.isStreaming:
        return df
    rows = df.withColumn(time, F.col(time).cast("timestamp"))
    return rows.withWatermark(time, watermark) if watermark else rows


def windowed(
    df: DataFrame,
    time: str,
    length: str,
    keys: Sequence[str] = (),
    slide: str | None = None,
    watermark: str | None = None,
    aggregates: Sequence[Column] | None = None,
) -> DataFrame:
    """Tumbling or sliding windows over batch or streaming rows.

    On a stream the time column becomes an instant, which watermarks require. Output columns
    are the keys, ``window_start``, ``window_end`` and the aggregates (``n`` by default).
    """
    rows = _event_time(df, time, watermark)
    span = F.window(F.col(time), length, slide) if slide else F.window(F.col(time), length)
    grouped = rows.groupBy(*keys, span.alias("__w")).agg(*(aggregates or [F.count(F.lit(1)).alias("n")]))
    return grouped.select(
        *keys,
        F.col("__w.start").alias("window_start"),
        F.col("__w.end").alias("window_end"),
        *[c for c in grouped.columns if c not in (*keys, "__w")],
    )


def sessions(df: DataFrame, time: str, gap: str, keys: Sequence[str], watermark: str | None = None) -> DataFrame:
    """The streaming twin of OP-109: gap-based sessions per key."""
    rows = _event_time(df, time, watermark)
    grouped = rows.groupBy(*keys, F.session_window(F.col(time), gap).alias("__w")).agg(F.count(F.lit(1)).alias("n"))
    return grouped.select(*keys, F.col("__w.start").alias("session_start"), F.col("__w.end").alias("session_end"), "n")
