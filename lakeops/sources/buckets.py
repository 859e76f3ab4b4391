"""Tables in hash buckets, whose current version one file names.

A version file lists the folder of each bucket. A merge rewrites the buckets its batch hits into
a new folder and then writes the next version file, so its cost follows the batch, and a reader
sees the version it began with or the next one, whole, and never a gap. Two writers that begin with
the same version cannot both write the next one: the second gets :class:`Conflict` and may try again.
Folders that no version names any more are deleted by :func:`drop_old_versions`.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakeops.operators.upsert import _any_null, upsert_all
from lakeops.sources.tables import _delete, _location, path_exists

_BUCKET = "__bucket"


class Conflict(Exception):
    """Another writer was faster."""


def _versions(spark: SparkSession, path: str) -> list[int]:
    location, system = _location(spark, f"{path}/versions")
    if not system.exists(location):
        return []
    names = [status.getPath().getName() for status in system.listStatus(location)]
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))


def _version(spark: SparkSession, path: str, number: int) -> dict:
    return json.loads(spark.read.text(f"{path}/versions/{number:012d}.json", wholetext=True).first()[0])


def current(spark: SparkSession, path: str) -> tuple[int, dict] | None:
    """Number and contents of the newest version; None where there is no table."""
    numbers = _versions(spark, path)
    return (numbers[-1], _version(spark, path, numbers[-1])) if numbers else None


def _publish(spark: SparkSession, path: str, number: int, version: dict) -> None:
    """Write a version file under its name all at once, unless there is one by now."""
    draft, system = _location(spark, f"{path}/drafts/{uuid.uuid4().hex}.json")
    out = system.create(draft, False)
    out.write(bytearray(json.dumps(version), "utf-8"))
    out.close()
    end, _ = _location(spark, f"{path}/versions/{number:012d}.json")
    system.mkdirs(end.getParent())
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(system.makeQualified(draft), system.makeQualified(end), no_options)
    except Exception as error:
        if number in _versions(spark, path):
            raise Conflict(f"version {number} of {path} was written by another writer") from error
        raise


def _read(spark: SparkSession, path: str, version: dict, buckets: Sequence[int] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(version["schema"])
    folders = [f for b, f in version["folders"].items() if buckets is None or int(b) in buckets]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/data/{folder}" for folder in folders])


def read(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The newest version of a table, or a given one that hasn't been dropped."""
    if number is not None:
        return _read(spark, path, _version(spark, path, number))
    found = current(spark, path)
    if found is None:
        raise FileNotFoundError(path)
    return _read(spark, path, found[1])


Merge = Callable[[DataFrame | None, DataFrame], DataFrame]


def merge(spark: SparkSession, path: str, updates: DataFrame, by: Sequence[str], body: Merge, buckets: int = 256, replace: bool = False) -> DataFrame:
    """OP-28/32/35: rewrite the buckets that ``updates`` hits with ``body(rows of these buckets, updates)``.

    Rows go to buckets by a hash of ``by``; ``buckets`` counts for a new table only. ``replace`` hits every
    bucket and gives ``body`` no rows. Columns whose name begins with ``_`` are written, to be read from the
    result, and are no part of the table. Returns the rows written; a batch without rows writes none and no
    version. Columns are those of the first version.
    """
    found = current(spark, path)
    number, version = found or (-1, {"folders": {}, "buckets": buckets, "schema": None})
    count = version["buckets"]
    bucket = F.pmod(F.xxhash64(*by), F.lit(count)).cast("int").alias(_BUCKET)
    new = uuid.uuid4().hex
    # The batch may be costly to make and is read several times.
    updates.select("*", bucket).write.partitionBy(_BUCKET).parquet(f"{path}/batches/{new}")
    batch = spark.read.schema(T.StructType([*updates.schema, T.StructField(_BUCKET, T.IntegerType())])).parquet(f"{path}/batches/{new}")
    try:
        hit = {row[_BUCKET] for row in batch.select(_BUCKET).distinct().collect()}  # at most as many as there are buckets
        old = None if replace or found is None else _read(spark, path, version, hit)
        merged = body(old, batch.drop(_BUCKET))
        kept = [f for f in merged.schema if not f.name.startswith("_")]
        written = T.StructType([*merged.schema, T.StructField(_BUCKET, T.IntegerType())])
        merged.select("*", bucket).hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).parquet(f"{path}/data/{new}")
        if not hit and not replace and found is not None:
            return merged.limit(0)
        location, system = _location(spark, f"{path}/data/{new}")
        made = [s.getPath().getName() for s in system.listStatus(location) if s.isDirectory()]
        folders = {} if replace else {b: f for b, f in version["folders"].items() if int(b) not in hit}
        folders |= {name.split("=")[1]: f"{new}/{name}" for name in made}
        schema = T.StructType(kept).jsonValue() if version["schema"] is None or replace else version["schema"]
        _publish(spark, path, number + 1, {"folders": folders, "buckets": count, "schema": schema})
    finally:
        _delete(spark, f"{path}/batches/{new}")
    return spark.read.schema(written).parquet(f"{path}/data/{new}").drop(_BUCKET)


def upsert(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str], buckets: int = 256) -> DataFrame:
    """OP-28/35: create the table, or merge a batch by key. A key that occurs twice in ``updates`` raises;
    null keys never match and may repeat. A batch merged again leaves the same rows."""

    def body(old: DataFrame | None, batch: DataFrame) -> DataFrame:
        if not batch.filter(~_any_null(keys)).groupBy(*keys).count().filter("count > 1").isEmpty():
            raise ValueError(f"keys {list(keys)} are not unique in the updates")
        return batch if old is None else upsert_all(old, batch, keys)

    return merge(spark, path, updates, keys, body, buckets)


def row_count(spark: SparkSession, path: str) -> int:
    """Rows of the newest version, from the files' footers; 0 where there is no table."""
    return read(spark, path).count() if current(spark, path) else 0


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete all but the newest ``keep`` versions, and the folders that none of those names."""
    numbers = _versions(spark, path)
    for number in numbers[:-keep]:
        _delete(spark, f"{path}/versions/{number:012d}.json")
    named = {folder for number in numbers[-keep:] for folder in _version(spark, path, number)["folders"].values()}
    if not path_exists(spark, f"{path}/data"):
        return
    location, system = _location(spark, f"{path}/data")
    for run in system.listStatus(location):
        used = [s for s in system.listStatus(run.getPath()) if f"{run.getPath().getName()}/{s.getPath().getName()}" in named]
        for part in [] if used else [run]:
            system.delete(part.getPath(), True)
        if used:
            keep_names = {s.getPath().getName() for s in used}
            for part in system.listStatus(run.getPath()):
                if part.isDirectory() and part.getPath().getName() not in keep_names:
                    system.delete(part.getPath(), True)
