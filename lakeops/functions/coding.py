"""Codes, flags, bands and typologies as generated expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def code_map(source: Column, mapping: Mapping[str, str], default: Column | str | None = None) -> Column:
    """OP-51: translate codes; unmapped codes take the default."""
    fallback = default if isinstance(default, Column) else F.lit(default)
    chain = None
    for code, label in mapping.items():
        chain = F.when(source == code, F.lit(label)) if chain is None else chain.when(source == code, F.lit(label))
    return fallback if chain is None else chain.otherwise(fallback)


def decode_flag(source: Column, labels: Mapping[str, str], default: str = "") -> Column:
    """OP-52: ``decode`` semantics, where null takes the default."""
    return code_map(source, labels, default)


def first_rule(rules: Iterable[tuple[Column, str]], default: str | None = None) -> Column:
    """OP-60/61: label of the first rule that holds."""
    chain = None
    for condition, label in rules:
        chain = F.when(condition, label) if chain is None else chain.when(condition, label)
    if chain is None:
        return F.lit(default)
    return chain.otherwise(F.lit(default))


def band(value: Column, upper_bounds: Sequence[tuple[float, str]], above: str) -> Column:
    """OP-60: label by inclusive, ascending upper bounds. Null stays null."""
    label = first_rule([(value <= bound, name) for bound, name in upper_bounds], above)
    return F.when(value.isNotNull(), label)


def flag(condition: Column) -> Column:
    """0/1 flag where an unknown condition counts as 0."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def count_where(columns: Sequence[str], condition) -> Column:
    """OP-63: how many of the columns satisfy the condition."""
    return reduce(lambda a, b: a + b, [flag(condition(F.col(c))) for c in columns], F.lit(0))


def flag_total(columns: Sequence[str]) -> Column:
    """OP-68: sum of flag columns, nulls as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in columns], F.lit(0))


def classify_codes(code_lists: Sequence[tuple[str, str, Sequence[str]]], default: str | None = None) -> Column:
    """OP-62: ordered ``(column, label, codes)`` lists over several code columns."""
    return first_rule([(F.col(c).isin(list(codes)), label) for c, label, codes in code_lists], default)


def decimal_comma(text: Column) -> Column:
    """OP-58: ``1 234,5`` or ``1234,5`` to double; unreadable text becomes null."""
    return F.translate(text, ", \u00a0\t", ".").try_cast("double")


def parse_date(text: Column, formats: Sequence[str]) -> Column:
    """OP-58: first format that fits, else null.

    A format is tried only on text of its shape: a failed parse costs an exception per row.
    """
    tries = []
    for layout in formats:
        shape = "^" + re.sub(r"\\?[A-Za-z]+", lambda _: r"\w+", re.escape(layout.replace("'", ""))) + "$"
        tries.append(F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(layout)).cast("date")))
    return F.coalesce(*tries)


def repair_scale(value: Column, bound: float, factor: float) -> Column:
    """OP-57: values whose magnitude is at most ``bound`` were stored unscaled."""
    return F.when(F.abs(value) > bound, value).otherwise(value * factor)


def slug(name: str) -> str:
    """OP-42: column name reduced to lower-case words joined by underscores."""
    import unicodedata

    plain = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode()
    return re.sub(r"[^a-z0-9]+", "_", plain.lower()).strip("_")


def slug_columns(df: DataFrame) -> DataFrame:
    names = [slug(c) or f"column_{i}" for i, c in enumerate(df.columns)]
    taken: set[str] = set()
    for i, name in enumerate(names):
        number, free = 1, name
        while free in taken:
            number += 1
            free = f"{name}_{number}"
        taken.add(free)
        names[i] = free
    return df.toDF(*names)


def one_hot(df: DataFrame, column: str, values: Sequence[str], prefix: str, missing: str = "missing") -> DataFrame:
    """OP-64: one 0/1 column per known value. The value list is an argument, so the
    output schema does not depend on the data."""
    flags = {f"{prefix}{slug(str(v))}": flag(F.col(column) == v) for v in values if v != missing}
    return df.withColumns(flags)


def known_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values, for the caller to choose the list of :func:`one_hot` from."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct()


def constant_placeholder(df: DataFrame, columns: Sequence[str], placeholder: str) -> DataFrame:
    """OP-67: columns with at most one distinct value become a placeholder."""
    spread = df.agg(*[F.min(c).alias(f"lo_{c}") for c in columns], *[F.max(c).alias(f"hi_{c}") for c in columns]).first()
    flat = [c for c in columns if spread[f"lo_{c}"] == spread[f"hi_{c}"]]
    return df.withColumns({c: F.lit(placeholder) for c in flat}) if flat else df
