"""OP-09/21: JDBC options. Connection settings always come from the caller."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def table_options(url: str, table: str, **extra: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, **extra}


def query_options(url: str, sql: str, **extra: str) -> dict[str, str]:
    """A subquery scan; the alias is what databases ask of a derived table."""
    return {"url": url, "dbtable": f"({sql.strip().rstrip(';')}) q", **extra}


def split_options(column: str, low: int, high: int, parts: int) -> dict[str, str]:
    """Read a table in parallel ranges instead of through one connection."""
    return {
        "partitionColumn": column,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(parts),
    }


def sink_options(url: str, table: str, truncate: bool = True, batch_size: int = 10_000, **extra: str) -> dict[str, str]:
    return {
        "url": url,
        "dbtable": table,
        "truncate": str(truncate).lower(),
        "batchsize": str(batch_size),
        **extra,
    }


def read(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def write(df: DataFrame, options: Mapping[str, str], mode: str = "overwrite", connections: int = 8) -> None:
    """``truncate`` with overwrite keeps the table's definition. ``connections`` bounds the
    parallel sessions on the database."""
    df.coalesce(connections).write.format("jdbc").options(**options).mode(mode).save()
