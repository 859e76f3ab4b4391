"""Incident log (MART-16)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakeops.functions.clock import duration_seconds, duration_text, service_clock
from lakeops.plans.ticketing import star


def incident_log(
    incidents: DataFrame,
    dims: Sequence[tuple[DataFrame, str, str]],
    line: Column,
    service_day: str = "service_day",
    started: str = "started_at",
    ended: str = "ended_at",
    wrap: bool = True,
) -> DataFrame:
    """Incidents with their labels, both ends on the 24h+ service clock, and duration.

    ``wrap`` shows durations on a 24-hour clock as fixed-width reports do.
    """
    rows = star(incidents, dims, "inner")
    start, end = F.col(started), F.col(ended)
    return rows.withColumns(
        {
            "line_number": F.substring_index(line, "/", 1),
            "start_clock": service_clock(start, F.col(service_day)),
            "end_clock": service_clock(end, F.col(service_day)),
            "duration": duration_text(start, end, wrap=wrap),
            "duration_min": duration_seconds(start, end) / 60,
        }
    )
