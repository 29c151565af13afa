"""Keyed dedupe and merge between two DataFrames.

Merges are an anti join plus a union: the target is never shuffled when the incoming side is
small enough for Spark to broadcast, and otherwise both sides shuffle once on the key, where
adaptive execution may split hot keys. Full outer joins are avoided because their hot keys
cannot be split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

INSERT, UPDATE, KEEP = "INSERT", "UPDATE", "KEEP"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row of every key in the given order.

    Spark trims each key to one row per map task before it shuffles, so a hot key stays small.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def dedupe(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] | None = None
) -> DataFrame:
    """One row per key: the first by `order`, or any one where no order is given."""
    if order:
        return first_per_key(df, keys, order)
    return df.dropDuplicates(list(keys))


def new_keys(
    df: DataFrame, known: DataFrame, keys: Sequence[str], unique: bool = False
) -> DataFrame:
    """Rows of `df` whose key is absent from `known`; a null key is never known.

    The known keys are made distinct first, which folds a hot key within each map task, unless
    the caller knows them to be `unique`.
    """
    seen = known.select(*keys)
    return df.join(seen if unique else seen.distinct(), list(keys), "left_anti")


def upsert(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Incoming rows replace the target rows that share their key; new columns are added."""
    fresh = dedupe(incoming, keys, order)
    kept = new_keys(target, incoming, keys)
    return kept.unionByName(fresh, allowMissingColumns=True).select(
        *target.columns, *(name for name in fresh.columns if name not in target.columns)
    )


def merge_with_actions(
    target: DataFrame,
    incoming: DataFrame,
    key: str,
    value: str,
    *,
    only_if_changed: bool,
    order: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Merged (key, value) rows with the action each row took.

    With `only_if_changed` a matched row is rewritten only when both values are known and
    differ; otherwise every matched row is rewritten. Only the key column of the target is
    shuffled to find the inserts, never its values.
    """
    fresh = dedupe(incoming, [key], order).select(key, value)
    updates = fresh.select(key, F.col(value).alias("_new"), F.lit(True).alias("_matched"))
    matched = F.coalesce(F.col("_matched"), F.lit(False))
    if only_if_changed:
        matched = matched & F.coalesce(F.col(value) != F.col("_new"), F.lit(False))
    merged = target.select(key, value).join(updates, key, "left")
    existing = merged.select(
        key,
        F.when(matched, F.col("_new")).otherwise(F.col(value)).alias(value),
        F.when(matched, F.lit(UPDATE)).otherwise(F.lit(KEEP)).alias("merge_action"),
    )
    inserted = new_keys(fresh, target, [key], unique=True).withColumn("merge_action", F.lit(INSERT))
    return existing.unionByName(inserted)


def action_counts(merged: DataFrame) -> DataFrame:
    """Rows per action that changed the table."""
    changed = merged.where(F.col("merge_action") != KEEP)
    return changed.groupBy("merge_action").agg(F.count(F.lit(1)).alias("rows"))
