"""Table writes, catalog statements and maintenance."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from lakeops.operators.upsert import _any_null, upsert_all


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.replace("`", "").split("."))


def path_exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def is_folder(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = location.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.exists(location) and system.getFileStatus(location).isDirectory()


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = (), files: int | None = None) -> None:
    """OP-15/17/25: replace a table. Partitioned writes are clustered by partition first, so
    a task opens few files; AQE splits partitions that are too big."""
    if files:
        df = df.repartition(files)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """OP-16."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def register(spark: SparkSession, name: str, path: str, kind: str = "parquet", **options: str) -> None:
    """OP-11/18: (re-)register a table over a path."""
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")
    listed = ", ".join(f"'{k}' '{v}'" for k, v in {**options, "path": path}.items())
    spark.sql(f"CREATE TABLE {_quoted(name)} USING {kind} OPTIONS ({listed})")


def save_mart(df: DataFrame, name: str) -> None:
    """OP-19/20: create or replace a managed table."""
    df.write.mode("overwrite").saveAsTable(_quoted(name))


def describe(spark: SparkSession, name: str) -> DataFrame:
    """OP-155."""
    return spark.sql(f"DESCRIBE FORMATTED {_quoted(name)}")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {_quoted(database)}")


def refresh(spark: SparkSession, name: str) -> None:
    spark.sql(f"REFRESH TABLE {_quoted(name)}")


def create_database(spark: SparkSession, name: str, path: str | None = None) -> None:
    """OP-155. ``path`` is where its managed tables live, if not in the warehouse."""
    where = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(name)}{where}")


def drop_with_files(spark: SparkSession, name: str, path: str | None = None) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")
    if path:
        location = spark._jvm.org.apache.hadoop.fs.Path(path)
        location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def create_or_upsert(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
) -> None:
    """OP-28: create the table, or merge a batch into the partitions it touches.

    Touched are the partitions the batch writes to and those where its keys live now (a
    matched row may change partition). Only they are read in full; they are written once,
    beside the table, and moved in. A call that ended midway is finished by the next one
    (:func:`recover`). Without partition columns the whole table is replaced the same way.

    Partition values have the types of ``updates``, whatever their folder names look like;
    empty text is stored as null, as partitioned writes do. A key that occurs twice in
    ``updates`` raises; null keys never match and may repeat.
    """
    recover(spark, path)
    parts, keys = list(partition_by), list(keys)
    staging = f"{path}.staging-{uuid.uuid4().hex}"
    fresh = not path_exists(spark, path)
    text = [p for p in parts if isinstance(updates.schema[p].dataType, T.StringType)]
    # The batch may be costly to make and is read several times.
    updates.withColumns({p: F.nullif(p, F.lit("")) for p in text}).write.parquet(f"{staging}/batch")
    batch = spark.read.schema(updates.schema).parquet(f"{staging}/batch")
    if not batch.filter(~_any_null(keys)).groupBy(*keys).count().filter("count > 1").isEmpty():
        _delete(spark, staging)
        raise ValueError(f"keys {keys} are not unique in the updates")
    gone: list[str] = []
    if fresh:
        merged = batch
    elif not parts:
        merged = upsert_all(spark.read.parquet(path), batch, keys)
    else:
        target = read_partitioned(spark, path, updates.schema, parts)
        batch = batch.select(*target.columns)
        folder = F.regexp_extract("_metadata.file_path", f"((?:/[^/]+){{{len(parts)}}})/[^/]+$", 1)
        known = target.select(*target.columns, folder.alias("__folder")).filter(~_any_null(keys))
        holding = known.join(batch.select(*keys), keys, "left_semi").select(*parts, "__folder").distinct()
        touched = batch.select(*parts).unionByName(holding.select(*parts)).distinct()
        same = reduce(lambda a, b: a & b, [target[p].eqNullSafe(touched[p]) for p in parts])
        merged = upsert_all(target.join(touched, same, "left_semi"), batch, keys)
        gone = [unquote(row["__folder"]).strip("/") for row in holding.select("__folder").distinct().collect()]
    overwrite(merged, f"{staging}/new", parts)
    if not parts or fresh:
        _move_in(spark, path, staging, None, [])
        return
    new = _folders(spark, f"{staging}/new", len(parts))
    # A touched partition whose every row moved away has no new folder.
    _move_in(spark, path, staging, new, sorted(set(gone) - set(new)))


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str]) -> DataFrame:
    """A partitioned table whose partition columns have the types of ``schema``: nothing is
    inferred from folder names, so 01 stays 01."""
    found = spark.read.parquet(path).schema
    typed = [T.StructField(f.name, schema[f.name].dataType) if f.name in partition_by else f for f in found]
    return spark.read.schema(T.StructType(typed)).parquet(path)


def replace_whole(spark: SparkSession, df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a table, which ``df`` may read: the old one stays until the new one is complete."""
    staging = f"{path}.staging-{uuid.uuid4().hex}"
    overwrite(df, f"{staging}/new", partition_by)
    _move_in(spark, path, staging, None, [])


def _location(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, path: str) -> None:
    location, system = _location(spark, path)
    system.delete(location, True)


def _move(spark: SparkSession, source: str, destination: str) -> None:
    start, system = _location(spark, source)
    end, _ = _location(spark, destination)
    system.mkdirs(end.getParent())
    if not system.rename(start, end):
        raise OSError(f"could not move {source} to {destination}")


def _folders(spark: SparkSession, root: str, depth: int, below: str = "") -> list[str]:
    """Partition folders of a table, relative to it."""
    if depth == 0:
        return [below]
    location, system = _location(spark, f"{root}/{below}" if below else root)
    names = [s.getPath().getName() for s in system.listStatus(location) if s.isDirectory()]
    return [f for n in sorted(names) if "=" in n for f in _folders(spark, root, depth - 1, f"{below}/{n}" if below else n)]


def _move_in(spark: SparkSession, path: str, staging: str, folders: list[str] | None, gone: list[str], **files: list) -> None:
    """Note what is to move, then move it: from here on the change is finished, now or by ``recover``."""
    note = json.dumps({"staging": staging, "folders": folders, "gone": gone, **files})
    location, system = _location(spark, f"{path}.pending.tmp")
    out = system.create(location, True)
    out.write(bytearray(note, "utf-8"))
    out.close()
    _move(spark, f"{path}.pending.tmp", f"{path}.pending")
    _finish(spark, path, note)


def _finish(spark: SparkSession, path: str, note: str) -> None:
    """Move what has not been moved yet; a folder that is no longer staged is in its place."""
    todo = json.loads(note)
    staging = todo["staging"]
    if todo["folders"] is None:
        pairs = [(f"{staging}/new", path)]
    else:
        pairs = [(f"{staging}/new/{f}", f"{path}/{f}") for f in todo["folders"]]
    for nth, (source, destination) in enumerate(pairs):
        if path_exists(spark, source):
            # The old folder goes aside, which is one rename; it is deleted with the staging folder.
            if path_exists(spark, destination):
                _move(spark, destination, f"{staging}/old-{uuid.uuid4().hex}/{nth}")
            _move(spark, source, destination)
    for source, destination in todo.get("files", []):
        if path_exists(spark, source):
            _move(spark, source, destination)
    for file in todo.get("old", []):
        _delete(spark, file)
    for folder in todo["gone"]:
        _delete(spark, f"{path}/{folder}")
    _delete(spark, f"{path}.pending")
    _delete(spark, staging)


def recover(spark: SparkSession, path: str) -> None:
    """Finish a replacement of this table that was noted but not carried out to its end."""
    if path_exists(spark, f"{path}.pending"):
        _finish(spark, path, spark.read.text(f"{path}.pending", wholetext=True).first()[0])


def compact(spark: SparkSession, source: str, destination: str, files: int, cluster_by: Sequence[str] = ()) -> None:
    """OP-24: rewrite many small files as ``files`` larger ones in a new folder."""
    df = spark.read.parquet(source)
    df = df.repartitionByRange(files, *cluster_by) if cluster_by else df.repartition(files)
    df.write.mode("overwrite").parquet(destination)


def compact_small(spark: SparkSession, path: str, target: int = 128 * 2**20, small: int | None = None, partition_by: Sequence[str] = ()) -> int:
    """OP-24: pack the small files of each folder into files of about ``target`` bytes; larger ones stay as they are.

    Files under ``small`` bytes (half of ``target`` where not given) are packed in the order of their names: a bin takes files
    until the next would begin beyond ``target``. A folder with one small file is left alone. Files are only listed; the
    rows of packed ones are read and written once. Returns the files replaced. As with any rewriting in
    place, a reader in the moment of the change may see rows of a file and of its bin; ``sources.buckets`` has versions.
    """
    recover(spark, path)
    parts, small = list(partition_by), target // 2 if small is None else small
    rows = spark.read.parquet(path)
    at = F.col("_metadata.file_path").alias("__file")
    files = rows.select(at, F.col("_metadata.file_size").alias("__size")).distinct().filter(F.col("__size") < small)
    files = files.withColumn("__folder", F.regexp_extract("__file", "^(.*)/[^/]+$", 1))
    inside = Window.partitionBy("__folder").orderBy("__file")
    before = F.coalesce(F.sum("__size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    binned = files.withColumn("__bin", F.floor(before / target).cast("long"))
    many = F.count(F.lit(1)).over(Window.partitionBy("__folder", "__bin")) > 1
    listed = binned.withColumn("__many", many).filter("__many").select("__file", "__folder", "__bin")
    staging = f"{path}.staging-{uuid.uuid4().hex}"
    listed.write.parquet(f"{staging}/bins")
    listed = spark.read.parquet(f"{staging}/bins")
    old = [unquote(r["__file"]) for r in listed.select("__file").collect()]
    if not old:
        _delete(spark, staging)
        return 0
    packed = rows.select("*", at).join(listed, "__file").drop("__file")
    number = F.dense_rank().over(Window.orderBy("__folder", "__bin"))
    bins = listed.select("__folder", "__bin").distinct().withColumn("__nth", number)
    packed = packed.join(bins, ["__folder", "__bin"]).drop("__folder", "__bin")
    # One task a bin, so one file a bin; ``target`` bounds it.
    packed.repartition("__nth").write.partitionBy(*parts, "__nth").parquet(f"{staging}/new")
    moves = []
    for folder in _folders(spark, f"{staging}/new", len(parts) + 1):
        location, system = _location(spark, f"{staging}/new/{folder}")
        home = "/".join(folder.split("/")[:-1])
        for status in system.listStatus(location):
            name = status.getPath().getName()
            if name.startswith("part-"):
                moves.append([f"{staging}/new/{folder}/{name}", "/".join(filter(None, (path, home, f"packed-{uuid.uuid4().hex}.parquet")))])
    _move_in(spark, path, staging, [], [], files=moves, old=old)
    return len(old)


def maintenance_statements(spark: SparkSession, database: str, properties: dict[str, str]) -> list[str]:
    """OP-24: one ALTER statement per table of a database."""
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    return [
        f"ALTER TABLE {_quoted(database)}.{_quoted(t.name)} SET TBLPROPERTIES ({listed})"
        for t in spark.catalog.listTables(database)
        if not t.isTemporary
    ]


def export_delimited(
    df: DataFrame, path: str, separator: str = ";", encoding: str = "UTF-8", single_file: bool = False
) -> None:
    """OP-22: delimited export with a header in every file. ``single_file`` is for
    report-sized results only: it writes from one task."""
    out = df.repartition(1) if single_file else df
    out.write.mode("overwrite").option("header", "true").option("sep", separator).option("encoding", encoding).csv(path)


def cache_now(df: DataFrame) -> DataFrame:
    """OP-23: eager cache."""
    kept = df.persist()
    kept.count()
    return kept


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """OP-10: a table by path or by catalog name."""
    return spark.read.parquet(name_or_path) if "/" in name_or_path else spark.table(_quoted(name_or_path))


def cache_as(df: DataFrame, name: str) -> DataFrame:
    """OP-23: named cache."""
    df.createOrReplaceTempView(name)
    df.sparkSession.catalog.cacheTable(name)
    return df.sparkSession.table(name)
