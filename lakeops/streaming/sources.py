"""File streams (OP-129/130/131)."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from lakeops.sources.tables import is_folder, path_exists


def file_stream(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    kind: str = "parquet",
    files_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Stream the files of a folder, or a single file, with a declared schema."""
    reader = spark.readStream.format(kind).schema(schema).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if not any(c in path for c in "*?[{") and not is_folder(spark, path):
        folder, _, name = path.rpartition("/")
        return reader.option("pathGlobFilter", name).load(folder)
    return reader.load(path)


def with_rescued(stream: DataFrame, schema: str | T.StructType, body: str = "value") -> DataFrame:
    """OP-130: typed columns of a JSON line plus the raw text of lines that do not fit.

    ``body`` is the text column of a ``text`` stream.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    bad = "__bad"
    read = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    parsed = stream.withColumn(
        "__row", F.from_json(F.col(body), read, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})
    )
    return parsed.select(
        *[F.col(f"__row.`{f.name}`").alias(f.name) for f in schema],
        F.col(f"__row.{bad}").alias("rescued"),
        *[c for c in stream.columns if c != body],
    )


def with_rescued_fields(rows: DataFrame, schema: str | T.StructType, body: str = "value") -> DataFrame:
    """OP-130: typed columns of a JSON line, and as ``rescued`` what they don't hold, in JSON.

    Rescued are fields that the schema doesn't have, and fields whose value doesn't fit their type (their column is
    null); of a line that is no JSON object all of it, as it came. Null where nothing is left over.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    parsed = rows.withColumns({"__raw": F.from_json(F.col(body), "map<string,string>"), "__row": F.from_json(F.col(body), schema)})
    misfit = lambda name: F.col(f"__row.`{name}`").isNull()

    def left_over(key: Column, value: Column) -> Column:
        unknown = ~key.isin([f.name for f in schema])
        return reduce(lambda x, y: x | y, [(key == f.name) & misfit(f.name) & value.isNotNull() for f in schema], unknown)

    kept = F.map_filter("__raw", left_over)
    rescued = F.when(F.col("__raw").isNull(), F.col(body)).when(F.size(kept) > 0, F.to_json(kept))
    others = [c for c in rows.columns if c != body]
    return parsed.select(*[F.col(f"__row.`{f.name}`").alias(f.name) for f in schema], rescued.alias("rescued"), *others)


def stored_schema(spark: SparkSession, path: str, initial: T.StructType) -> T.StructType:
    """The columns that a growing table has by now."""
    if not path_exists(spark, f"{path}/_columns"):
        return initial
    newest = spark.read.text(f"{path}/_columns").select("value", F.col("_metadata.file_path").alias("at")).agg(F.max_by("value", "at")).first()[0]
    return T.StructType.fromJson(json.loads(newest))


def growing_table(path: str, initial: str | T.StructType, body: str = "value") -> Callable[[DataFrame, int], None]:
    """OP-130: batch body that appends JSON lines to a table whose columns grow with them.

    Fields no column holds yet become columns before the batch is written: bigint, double or boolean if all their
    values in the batch are, else text. Values that don't fit, later or earlier, are in ``rescued``. A batch run again
    replaces what it had written.
    """
    initial = T.StructType.fromDDL(initial) if isinstance(initial, str) else initial
    kinds = ("bigint", "double", "boolean")

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        schema = stored_schema(spark, path, initial)
        field = batch.select(F.explode(F.from_json(F.col(body), "map<string,string>")).alias("name", "text")).filter(F.col("text").isNotNull())
        field = field.filter(~F.col("name").isin(schema.names)).groupBy("name")
        # A row a new column.
        found = field.agg(*[F.every(F.col("text").try_cast(k).isNotNull()).alias(k) for k in kinds]).orderBy("name").collect()
        added = [T.StructField(r["name"], T._parse_datatype_string(next((k for k in kinds if r[k]), "string"))) for r in found]
        if added:
            schema = T.StructType([*schema, *added])
            line = spark.createDataFrame([(json.dumps(schema.jsonValue()),)], "value string")
            line.coalesce(1).write.mode("overwrite").text(f"{path}/_columns/at={batch_id:012d}")
        with_rescued_fields(batch.select(body), schema, body).write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")

    return run


def read_growing(spark: SparkSession, path: str, initial: str | T.StructType) -> DataFrame:
    """The rows of all batches, with the columns there are by now."""
    initial = T.StructType.fromDDL(initial) if isinstance(initial, str) else initial
    schema = stored_schema(spark, path, initial)
    return spark.read.schema(T.StructType([*schema, T.StructField("rescued", T.StringType())])).parquet(f"{path}/rows").drop("batch")


def start_each(names: Iterable[str], start: Callable[[str], StreamingQuery]) -> dict[str, StreamingQuery]:
    """OP-131: one query per object."""
    return {name: start(name) for name in names}
