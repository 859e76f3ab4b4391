"""Sinks, triggers and query management (OP-35, OP-136..145)."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lakeops.operators.joins import latest_per_key
from lakeops.sources.buckets import upsert
from lakeops.sources.tables import create_or_upsert, overwrite


def stateful_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """OP-145: a session whose state is spread over as many partitions as there are cores.

    The partition count of a stateful query is fixed at its first start; a session of its
    own leaves the caller's settings alone. Its zone is UTC, so windows over zone-less
    timestamps, which a stream has to turn into instants, keep to their own clock.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.shuffle.partitions", str(partitions or spark.sparkContext.defaultParallelism))
    return session


def trigger_options(mode: str, interval: str | None = None) -> dict:
    """OP-137: keyword arguments for ``trigger``."""
    modes = {
        "available": {"availableNow": True},
        "processing": {"processingTime": interval},
        "continuous": {"continuous": interval},
        "default": {},
    }
    if mode not in modes or (mode in ("processing", "continuous") and not interval):
        raise ValueError(f"unusable trigger: {mode} {interval}")
    return modes[mode]


def _start(writer, trigger: dict) -> StreamingQuery:
    return (writer.trigger(**trigger) if trigger else writer).start()


def append_files(
    stream: DataFrame, path: str, checkpoint: str, name: str | None = None, trigger: dict | None = None,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """OP-138: exactly-once append to Parquet; a restart continues from the checkpoint."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    writer = writer.option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    return _start(writer, trigger or {})


def each_batch(
    stream: DataFrame, body: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append",
    name: str | None = None, trigger: dict | None = None,
) -> StreamingQuery:
    """OP-139: foreachBatch sink."""
    writer = stream.writeStream.foreachBatch(body).outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return _start(writer, trigger or {})


def replace_table(path: str) -> Callable[[DataFrame, int], None]:
    """Batch body for complete mode: the table is the latest full result."""

    def body(batch: DataFrame, batch_id: int) -> None:
        overwrite(batch, path)

    return body


def upsert_table(
    path: str, keys: Sequence[str], order: Sequence[str], partition_by: Sequence[str] = ()
) -> Callable[[DataFrame, int], None]:
    """OP-35/140: dedupe the batch on its key (greatest ``order`` wins), then merge it.

    Running a batch again leaves the same table, so a retried batch is harmless.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        create_or_upsert(batch.sparkSession, path, latest_per_key(batch, keys, order), keys, partition_by)

    return body


def upsert_buckets(path: str, keys: Sequence[str], order: Sequence[str], buckets: int = 256) -> Callable[[DataFrame, int], None]:
    """OP-35/140: as :func:`upsert_table`, into a bucketed table: a batch rewrites only the buckets its keys
    fall into, and readers see whole versions."""

    def body(batch: DataFrame, batch_id: int) -> None:
        upsert(batch.sparkSession, path, latest_per_key(batch, keys, order), keys, buckets)

    return body


def run_available(query: StreamingQuery, timeout_s: int | None = None) -> StreamingQuery:
    """Wait for an ``availableNow`` query and raise its failure, if any."""
    finished = query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination()
    if finished is False:
        query.stop()
        raise TimeoutError(f"stream still running after {timeout_s} s")
    return query


def wait_until_ready(query: StreamingQuery, batches: int = 1, timeout_s: float = 60.0) -> bool:
    """OP-49: wait until a running query has finished some batches."""
    deadline = time.monotonic() + timeout_s
    while time.monotonic() < deadline:
        if query.exception() is not None or not query.isActive:
            return False
        if len(query.recentProgress) >= batches:
            return True
        time.sleep(0.1)
    return False


def active_queries(spark: SparkSession) -> dict[str, StreamingQuery]:
    """OP-143."""
    return {q.name or q.id: q for q in spark.streams.active}


def find_query(spark: SparkSession, name: str) -> StreamingQuery | None:
    return active_queries(spark).get(name)


def progress_rows(query: StreamingQuery) -> list[dict]:
    """OP-143: rows in, rows per second and duration of the recent batches."""
    return [
        {
            "batch": p["batchId"],
            "rows": p["numInputRows"],
            "rows_per_second": p.get("processedRowsPerSecond"),
            "ms": p.get("durationMs", {}).get("triggerExecution"),
        }
        for p in query.recentProgress
    ]


def stop_all(spark: SparkSession) -> None:
    for query in spark.streams.active:
        query.stop()
