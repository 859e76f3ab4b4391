"""File scans."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import date
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def daily_drop_path(root: str, name: str, day: date | None = None) -> str:
    """OP-01/02: landing path of an object for one day, or for its whole history."""
    where = "*/*/*" if day is None else day.strftime("%Y/%m/%d")
    return f"{root.rstrip('/')}/{name}/{where}/{name}*.parquet"


def read_daily_drop(spark: SparkSession, root: str, name: str, day: date | None = None) -> DataFrame:
    return spark.read.parquet(daily_drop_path(root, name, day))


def read_history(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """OP-03: every file below a root in one scan, with its path for ordering."""
    return with_provenance(
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).parquet(root)
    )


def read_partitions(spark: SparkSession, root: str, paths: Sequence[str]) -> DataFrame:
    """OP-04: some partitions of a Hive-style table, merged schema, partition values as text.

    Values are taken from the folder names as they stand, since inference turns 01 into 1; no session
    setting changes.
    """
    df = spark.read.option("mergeSchema", "true").option("basePath", root).parquet(*paths)
    names = list(dict.fromkeys(part.split("=")[0] for p in paths for part in PurePosixPath(p).parts if "=" in part))
    return df.withColumns({n: _folder_value(n) for n in names if n in df.columns}) if names else df


def _folder_value(name: str) -> Column:
    """The value in a folder ``name=value``: escaped by the writer and once more in the path."""
    value = F.regexp_extract(F.col("_metadata.file_path"), f"/{name}=([^/]*)/", 1)
    for _ in range(2):
        value = F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))
    return F.when(value != "__HIVE_DEFAULT_PARTITION__", value)


# The encodings Spark's text readers accept.
SPARK_ENCODINGS = {"iso-8859-1", "us-ascii", "utf-16", "utf-16be", "utf-16le", "utf-32", "utf-8"}


def _byte_table(encoding: str) -> tuple[str, str]:
    """Characters a one-byte encoding reads differently from ISO-8859-1: (read as, meant)."""
    pairs = []
    for byte in range(128, 256):
        meant = bytes([byte]).decode(encoding, errors="ignore")
        if meant and meant != chr(byte):
            pairs.append((chr(byte), meant))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType | None = None,
    encoding: str | None = None,
    separator: str = ";",
    infer: bool = False,
) -> DataFrame:
    """OP-05/06: delimited text with a header.

    Other one-byte encodings (``cp1252``, say) are read as ISO-8859-1 and translated, by
    column expression, on the executors.
    """
    reader = spark.read.option("header", "true").option("sep", separator)
    translated = encoding is not None and encoding.lower() not in SPARK_ENCODINGS
    if encoding:
        reader = reader.option("encoding", "iso-8859-1" if translated else encoding)
    if schema is not None:
        df = reader.schema(schema).csv(path)
    else:
        df = reader.option("inferSchema", str(infer).lower()).csv(path)
    if not translated:
        return df
    read, meant = _byte_table(encoding)
    names = str.maketrans(read, meant)
    return df.select(
        *[
            (F.translate(F.col(f"`{f.name}`"), read, meant) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`"))
            .alias(f.name.translate(names))
            for f in df.schema
        ]
    )


def read_any(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """OP-07/08: reader by extension."""
    suffix = PurePosixPath(path).suffix.lower()
    if suffix == ".parquet":
        return spark.read.parquet(path)
    if suffix == ".csv":
        return read_delimited(spark, path, schema, separator=",")
    if suffix in (".json", ".jsonl"):
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.json(path)
    raise ValueError(f"no reader for {suffix or 'a path without extension'}")


def with_provenance(df: DataFrame) -> DataFrame:
    """OP-13: file path, name, size and modification time of every row."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("file_modified_at"),
    )


def empty(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    """OP-12."""
    return spark.createDataFrame([], schema)


def save_schema(spark: SparkSession, schema: T.StructType, path: str) -> None:
    """OP-14: keep a schema as JSON next to the data."""
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_schema(spark: SparkSession, path: str) -> T.StructType:
    """OP-14. Accepts schemas that were JSON-encoded twice."""
    text = spark.read.text(path, wholetext=True).first()[0]
    content = json.loads(text)
    return T.StructType.fromJson(json.loads(content) if isinstance(content, str) else content)
