"""Unions, melts and schema alignment."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """OP-117."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def union_distinct(parts: Sequence[DataFrame]) -> DataFrame:
    """OP-116, by name: columns cannot swap silently between branches."""
    return union_all(parts).distinct()


def _default(kind: T.DataType, text: str, number: int):
    if isinstance(kind, T.StringType):
        return F.lit(text)
    if isinstance(kind, T.NumericType):
        return F.lit(number)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01")
    return F.lit(None)


def harmonised_union(
    left: DataFrame,
    right: DataFrame,
    typed_defaults: bool = False,
    default_text: str = "missing",
    default_number: int = 0,
    strict_nullability: bool = False,
) -> DataFrame:
    """OP-118: union where each side gets the columns it lacks (null, or a typed default).

    A shared column of different type is an error; of different nullability only when
    ``strict_nullability`` is set.
    """
    for field in left.schema:
        if field.name in right.columns:
            other = right.schema[field.name]
            if other.dataType != field.dataType:
                raise TypeError(f"column {field.name}: {field.dataType} against {other.dataType}")
            if strict_nullability and other.nullable != field.nullable:
                raise TypeError(f"column {field.name}: nullable on one side only")
    if not typed_defaults:
        return left.unionByName(right, allowMissingColumns=True)

    def completed(df, other):
        lacking = [f for f in other.schema if f.name not in df.columns]
        return df.withColumns(
            {f.name: _default(f.dataType, default_text, default_number).cast(f.dataType) for f in lacking}
        )

    return completed(left, right).unionByName(completed(right, left))


def melt(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], variable: str = "variable", value: str = "value",
    drop_nulls: bool = False,
) -> DataFrame:
    """OP-119: wide to long."""
    long = df.unpivot(list(ids), list(values), variable, value)
    return long.dropna(subset=[value]) if drop_nulls else long
