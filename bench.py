"""Headline queries at one scale; prints one JSON line.

Each query is forced with a ``noop`` write: one warm-up, then the median of the timed runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "headway_rollup", "tram_headway", "punctuality", "hour_band_range_join", "nearest_event", "boarding_stops",
    "range_counts", "lookback_3m", "lookback_forward", "star_left_counts", "role_playing_dims", "monthly_sales",
    "revenue_by_account", "active_at_boundary", "chain_neighbours_cumulative", "forward_fill", "islands", "island_lengths",
    "frequency_typology", "event_runs", "group_percentiles", "conditional_shares", "calendar_dim", "upsert_all",
    "hash_merge", "upsert_partitioned", "replay_latest_wins", "chi2_screen", "tumbling_counts", "stream_complete_equals_batch",
)


def main() -> None:
    from lakeops.registry import QUERIES
    from lakeops.session import build_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("OFF")
    took = {}
    for name in list(QUERIES) if names == ["all"] else names:
        times = []
        for _ in range(runs + 1):
            begin = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - begin)
        took[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
