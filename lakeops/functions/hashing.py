"""Row identity."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T


#: Six digits of a second; the default prints three, which makes different rows equal.
JSON_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _text(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    kind = field.dataType
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(column, JSON_TIMES)
    if isinstance(kind, T.BinaryType):
        return F.hex(column)
    return column.cast("string")


def row_hash(
    df: DataFrame,
    null_token: str | None = None,
    number_formats: Mapping[str, str] | None = None,
    separator: str = "||",
) -> Column:
    """OP-40: SHA-256 over the columns in name order.

    Without ``null_token`` nulls are skipped, so a null and an absent value hash
    alike. ``number_formats`` fixes the type a column is cast to before printing,
    since engines print doubles differently.
    """
    formats = number_formats or {}
    parts = []
    for field in sorted(df.schema.fields, key=lambda f: f.name):
        if field.name in formats:
            text = F.col(f"`{field.name}`").cast(formats[field.name]).cast("string")
        else:
            text = _text(field)
        parts.append(text if null_token is None else F.coalesce(text, F.lit(null_token)))
    return F.sha2(F.concat_ws(separator, *parts), 256)


def with_identity(
    df: DataFrame,
    load_id: str,
    prefix_length: int = 1,
    null_token: str | None = None,
    number_formats: Mapping[str, str] | None = None,
) -> DataFrame:
    """OP-41: hash, hash-prefix partition and first/last load columns."""
    return df.withColumns({"row_key": row_hash(df, null_token, number_formats)}).withColumns(
        {
            "row_bucket": F.substring("row_key", 1, prefix_length),
            "first_load_id": F.lit(load_id),
            "last_load_id": F.lit(load_id),
        }
    )
