"""Keyed upserts as pure functions: (target, updates) to the new table.

Null keys never match, as in SQL equality: such updates are inserted and such target
rows stay. ``_op`` (on request) tells what happened to each row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lakeops.operators.joins import latest_per_key

KEPT, UPDATED, INSERTED = "kept", "updated", "inserted"


def key_columns(expression: str) -> list[str]:
    """OP-26: ``a|b`` to its column list."""
    keys = [k.strip() for k in expression.split("|")]
    if not all(keys):
        raise ValueError(f"empty key part in {expression!r}")
    return keys


def match_condition(expression: str, target: str = "old", updates: str = "updates") -> str:
    """OP-26: the equality condition as SQL text, for engines with their own merge."""
    return " and ".join(f"{target}.`{k}` = {updates}.`{k}`" for k in key_columns(expression))


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])




def upsert_all(target: DataFrame, updates: DataFrame, keys: Sequence[str], with_op: bool = False) -> DataFrame:
    """OP-27: matched rows take every column of the update, unmatched updates are inserted.

    Keys are unique on both sides. Target rows with a null key skip the join: they cannot
    match, and would all meet in one shuffle partition.
    """
    updates = updates.select(*target.columns)
    keys = list(keys)
    without_key = target.filter(_any_null(keys))
    kept = target.filter(~_any_null(keys)).join(updates.select(*keys), keys, "left_anti")
    kept = kept.select(*target.columns).unionByName(without_key)
    if not with_op:
        return kept.unionByName(updates)
    known = target.select(*keys).withColumn("__known", F.lit(True))
    marked = updates.join(known, keys, "left").withColumn(
        "_op", F.when(F.col("__known"), F.lit(UPDATED)).otherwise(F.lit(INSERTED))
    )
    return kept.withColumn("_op", F.lit(KEPT)).unionByName(marked.select(*target.columns, "_op"))


def upsert_evolving(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """OP-29: columns new in the update are added (null on old rows), columns it lacks keep
    their value on matched rows."""
    keys = list(keys)
    added = [f for f in updates.schema if f.name not in target.columns]
    lacking = [f for f in target.schema if f.name not in updates.columns]
    wide_target = target.withColumns({f.name: F.lit(None).cast(f.dataType) for f in added}) if added else target
    if not lacking:
        return upsert_all(wide_target, updates, keys)
    old = target.filter(~_any_null(keys)).select(*keys, *[F.col(f.name) for f in lacking])
    return upsert_all(wide_target, updates.join(old, keys, "left").select(*wide_target.columns), keys)


def upsert_adding(target: DataFrame, updates: DataFrame, keys: Sequence[str], totals: Sequence[str]) -> DataFrame:
    """OP-30: matched totals are added up. A null on either side of a match gives null, as
    SQL addition does."""
    keys = list(keys)
    rest = [c for c in target.columns if c not in keys and c not in totals]
    t, u = target.withColumn("__t", F.lit(True)).alias("t"), updates.withColumn("__u", F.lit(True)).alias("u")
    on = reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"u.{k}") for k in keys])
    matched = F.col("__t") & F.col("__u")
    either = lambda c: F.when(F.col("__t"), F.col(f"t.{c}")).otherwise(F.col(f"u.{c}"))
    columns = {c: either(c) for c in [*keys, *rest]}
    for c in totals:
        columns[c] = F.when(matched, F.col(f"t.{c}") + F.col(f"u.{c}")).otherwise(either(c))
    return t.join(u, on, "full").select(*[columns[c].alias(c) for c in target.columns])


def replay_latest(history: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """OP-31: what successive merges of the files in ``order`` would leave: last file wins.

    Rows with a null key never match, so all of them stay.
    """
    latest = latest_per_key(history.filter(~_any_null(keys)), keys, order)
    return latest.unionByName(history.filter(_any_null(keys)))


def merge_by_hash(
    target: DataFrame, updates: DataFrame, key: str = "row_key", bucket: str | None = "row_bucket",
    refreshed: Sequence[str] = ("last_load_id",), with_op: bool = False,
) -> DataFrame:
    """OP-32: a known content hash only refreshes its load columns, a new one is inserted."""
    on = [key] if bucket is None else [key, bucket]
    # One row per content, so rows repeated in a load do not multiply target rows.
    fresh = updates.groupBy(*on).agg(*[F.max(c).alias(f"__new_{c}") for c in refreshed]).withColumn("__hit", F.lit(True))
    old = target.join(fresh, on, "left")
    old = old.withColumns(
        {
            **{c: F.when(F.col("__hit"), F.col(f"__new_{c}")).otherwise(F.col(c)) for c in refreshed},
            "_op": F.when(F.col("__hit"), F.lit(UPDATED)).otherwise(F.lit(KEPT)),
        }
    ).select(*target.columns, "_op")
    new = updates.join(target.select(*on), on, "left_anti").select(*target.columns).withColumn("_op", F.lit(INSERTED))
    merged = old.unionByName(new)
    return merged if with_op else merged.drop("_op")


def merge_metrics(merged: DataFrame) -> DataFrame:
    """OP-33: rows per outcome of a merge made ``with_op``."""
    return merged.agg(
        *[F.coalesce(F.sum(F.when(F.col("_op") == op, 1)), F.lit(0)).alias(f"rows_{op}") for op in (KEPT, UPDATED, INSERTED)]
    )
