"""OP-144: message-bus options and event bodies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakeops.functions.hashing import JSON_TIMES


def consumer_options(servers: str, topic: str, start: str = "earliest", per_trigger: int | None = None, **extra) -> dict:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start, **extra}
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def producer_options(servers: str, topic: str, checkpoint: str, **extra) -> dict:
    return {"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint, **extra}


def consume(spark: SparkSession, options: dict) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load().withColumnRenamed("value", "body")


def as_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as JSON message bodies."""
    body = F.to_json(F.struct(*df.columns), JSON_TIMES).alias("value")
    return df.select(F.col(key).cast("string").alias("key"), body) if key else df.select(body)


def flatten_body(df: DataFrame, schema: str | T.StructType, body: str = "body") -> DataFrame:
    """OP-141: JSON body to typed columns, one level of structs flattened."""
    parsed = df.withColumn("__body", F.from_json(F.col(body).cast("string"), schema))
    kind = parsed.schema["__body"].dataType
    columns = []
    for field in kind:
        if isinstance(field.dataType, T.StructType):
            columns += [F.col(f"__body.{field.name}.{s.name}").alias(f"{field.name}_{s.name}") for s in field.dataType]
        else:
            columns.append(F.col(f"__body.{field.name}").alias(field.name))
    return parsed.select(*[c for c in df.columns if c != body], *columns)
