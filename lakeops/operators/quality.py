"""Profiling and quality checks."""

from __future__ import annotations

import time
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakeops.functions.hashing import JSON_TIMES
from lakeops.session import local_table

# Warehouse column types by Spark type name.
WAREHOUSE_TYPES = {
    "string": "nvarchar(4000)",
    "boolean": "bit",
    "tinyint": "smallint",
    "smallint": "smallint",
    "int": "int",
    "bigint": "bigint",
    "float": "real",
    "double": "float",
    "date": "date",
    "timestamp": "datetime2",
    "timestamp_ntz": "datetime2",
    "binary": "varbinary(max)",
}


def schema_rows(df: DataFrame) -> DataFrame:
    """OP-43: one row per column, in column order."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema)]
    return local_table(df.sparkSession, rows, "position int, column string, type string, nullable boolean")


def schema_text(df: DataFrame) -> str:
    return "|".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def warehouse_type(kind: T.DataType) -> str:
    """OP-44. Structs and lists are kept as text; another type that has no counterpart raises."""
    if isinstance(kind, T.StructType | T.ArrayType):
        return "nvarchar(max)"
    if isinstance(kind, T.DecimalType):
        return f"decimal({kind.precision},{kind.scale})"
    if kind.simpleString() not in WAREHOUSE_TYPES:
        raise ValueError(f"no warehouse type for {kind.simpleString()}")
    return WAREHOUSE_TYPES[kind.simpleString()]


def warehouse_columns(df: DataFrame) -> DataFrame:
    rows = [(f.name, f.dataType.simpleString(), warehouse_type(f.dataType)) for f in df.schema]
    return local_table(df.sparkSession, rows, "column string, type string, warehouse_type string")


def column_profile(df: DataFrame) -> DataFrame:
    """OP-43/44 with content: type, warehouse type and filled values per column, one pass."""
    counts = df.agg(*[F.count(f"`{c}`").alias(f"n{i}") for i, c in enumerate(df.columns)])
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.lit(warehouse_type(f.dataType)).alias("warehouse_type"),
                F.col(f"n{i}").alias("filled"),
            )
            for i, f in enumerate(df.schema)
        ]
    )
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def field_paths(schema: T.StructType, prefix: str = "") -> Iterator[tuple[str, str]]:
    """OP-45: every nested column path with its type."""
    for field in schema:
        path = f"{prefix}{field.name}"
        yield path, field.dataType.simpleString()
        kind = field.dataType
        while isinstance(kind, T.ArrayType):
            kind = kind.elementType
        if isinstance(kind, T.StructType):
            yield from field_paths(kind, f"{path}.")


def catalog_columns(spark: SparkSession, databases: Sequence[str] | None = None) -> DataFrame:
    """OP-45: every column of every table in the catalog."""
    rows = []
    for database in databases or [d.name for d in spark.catalog.listDatabases()]:
        for table in spark.catalog.listTables(database):
            name = f"`{database}`.`{table.name}`" if not table.isTemporary else f"`{table.name}`"
            for path, kind in field_paths(spark.table(name).schema):
                rows.append((database, table.name, path, kind))
    return local_table(spark, rows, "database string, table string, column string, type string")


def find_columns(spark: SparkSession, text: str, databases: Sequence[str] | None = None) -> DataFrame:
    return catalog_columns(spark, databases).filter(F.lower("column").contains(text.lower()))


def duplicate_counts(df: DataFrame) -> DataFrame:
    """OP-46: rows before and after exact duplicate removal.

    Rows meet by the SHA-256 of their content, so long texts are read but not shuffled.
    """
    content = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {**JSON_TIMES, "ignoreNullFields": "false"}), 256)
    return (
        df.groupBy(F.unhex(content).alias("__content"))
        .agg(F.count(F.lit(1)).alias("__n"))
        .agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("rows_before"), F.count(F.lit(1)).alias("rows_after"))
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    """OP-48/94: keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).filter(F.col(out) > 1)


def rows_per_partition(df: DataFrame) -> DataFrame:
    """OP-49."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))


def file_stats(df: DataFrame) -> DataFrame:
    """OP-49: files and bytes behind a file-based frame."""
    files = df.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.max("_metadata.file_size").alias("bytes"), F.count(F.lit(1)).alias("rows")
    )
    return files.agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")
    )


def timed_count(df: DataFrame) -> tuple[int, float]:
    """OP-49: row count and the seconds it took."""
    begin = time.perf_counter()
    return df.count(), time.perf_counter() - begin


def expect_schema(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """OP-50: expected against actual column types."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    rows = [(c, kind, actual.get(c), actual.get(c) == kind) for c, kind in expected.items()]
    return local_table(df.sparkSession, rows, "column string, expected string, actual string, ok boolean")


def fingerprint(df: DataFrame) -> DataFrame:
    """OP-50: order-independent fingerprint of a frame: rows and the sum of their hashes, so repeated rows don't cancel out."""
    row = F.xxhash64(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in sorted(df.columns)])
    return df.select(row.alias("h")).agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.col("h").cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").alias("fingerprint"))


def expect_fingerprint(df: DataFrame, name: str, expected: int) -> DataFrame:
    return fingerprint(df).select(
        F.lit(name).alias("check"), (F.col("fingerprint") == F.lit(expected)).alias("ok")
    )
