"""Load bookkeeping: pending files, dataset ids, treatments and audit logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeops.functions.coding import slug_columns
from lakeops.functions.hashing import with_identity
from lakeops.operators.upsert import INSERTED, merge_by_hash, merge_metrics, upsert_evolving
from lakeops.sources.buckets import merge, row_count

# Load treatments and what they do to the target.
TREATMENTS = {
    "truncate_load": "overwrite",
    "reload": "overwrite",
    "overwrite": "overwrite",
    "append": "merge",
    "delta": "merge",
    "full": "merge",
    "snapshot": "merge",
}


def action_for(treatment: str) -> str:
    """OP-34. ``append`` merges, so a file loaded twice adds nothing."""
    if treatment not in TREATMENTS:
        raise ValueError(f"unknown load treatment: {treatment}")
    return TREATMENTS[treatment]


def pending_files(files: DataFrame, loads: DataFrame, path: str = "file_path", status: str = "load_status",
                  success: Sequence[str] = ("success",)) -> DataFrame:
    """OP-37: listed files without a successful load."""
    done = loads.filter(F.col(status).isin(list(success))).select(path).distinct()
    return files.join(done, path, "left_anti")


def file_time(path: Column, modified_at: Column, pattern: str = r"(\d{8}_\d{6})", layout: str = "yyyyMMdd_HHmmss") -> Column:
    """OP-38: time stamped into the file name, else the modification time."""
    stamp = F.regexp_extract(path, pattern, 1)
    return F.coalesce(F.try_to_timestamp(F.nullif(stamp, F.lit("")), F.lit(layout)), modified_at)


def dataset_from_name(path: Column, separator: str = "__") -> Column:
    """OP-39: leading parts of a file name as the dataset id; null when it has no parts."""
    name = F.substring_index(path, "/", -1)
    return F.when(name.contains(separator), F.lower(F.substring_index(name, separator, 1)))


def with_dataset(files: DataFrame, roots: DataFrame, path: str = "file_path", separator: str = "__") -> DataFrame:
    """OP-39: dataset id from the file name, else from the longest root the path starts with.

    ``roots`` has (root, dataset_id). A path is matched to its own folder prefixes by
    equi join, so the roots table may be of any size.
    """
    depth = F.size(F.split(F.col(path), "/"))
    prefixes = files.select(path).distinct().withColumn(
        "root",
        F.explode(
            F.transform(F.sequence(F.lit(1), depth), lambda n: F.array_join(F.slice(F.split(F.col(path), "/"), 1, n), "/"))
        ),
    )
    cleaned = roots.select(F.regexp_replace("root", "/+$", "").alias("root"), F.col("dataset_id").alias("by_root"))
    longest = prefixes.join(cleaned, "root").groupBy(path).agg(F.max_by("by_root", F.length("root")).alias("by_root"))
    return (
        files.join(longest, path, "left")
        .withColumn("dataset_id", F.coalesce(dataset_from_name(F.col(path), separator), F.col("by_root")))
        .drop("by_root")
    )


def prepare(df: DataFrame, load_id: str, null_token: str | None = None) -> DataFrame:
    """OP-40..42: slugged names, content hash, bucket and load ids."""
    return with_identity(slug_columns(df), load_id, null_token=null_token)


def load(
    spark: SparkSession, df: DataFrame, path: str, load_id: str, treatment: str, null_token: str | None = None, buckets: int = 256
) -> DataFrame:
    """OP-32..34: bring one landing frame into a bucketed table (``sources.buckets``) and report what happened.

    Overwriting treatments replace the table; merging ones refresh the load id of known rows and insert new
    ones, rewriting only the buckets with a row of the load, once. Returns one row of metrics.
    """
    prepared = prepare(df, load_id, null_token)
    replace = action_for(treatment) == "overwrite"

    def body(old: DataFrame | None, batch: DataFrame) -> DataFrame:
        if old is None:
            return batch.withColumn("_op", F.lit(INSERTED))
        return merge_by_hash(old.select(*batch.columns), batch, with_op=True)

    before = 0 if replace else row_count(spark, path)
    written = merge(spark, path, prepared, ["row_key"], body, buckets, replace)
    metrics = merge_metrics(written)
    # Rows of buckets that the load didn't hit are kept as well.
    kept = F.lit(before) - F.col("rows_updated")
    return metrics.withColumns({"rows_kept": kept.cast(metrics.schema["rows_kept"].dataType), "load_id": F.lit(load_id)})


def log_rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def write_log(log: DataFrame | None, rows: DataFrame, key: str = "load_id") -> DataFrame:
    """OP-36: a job log keyed by load or scan id whose columns grow as steps report more."""
    return rows if log is None else upsert_evolving(log, rows, [key])
