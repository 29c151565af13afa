"""Input validation: uniqueness, nulls and batch size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_JOB_ROWS = 100


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def require_unique(df: DataFrame, keys: Sequence[str], side: str) -> None:
    """Fail when a join side that must be unique on `keys` is not."""
    if not duplicate_keys(df, keys).isEmpty():
        raise ValueError(f"{side} has duplicate keys {list(keys)}")


def input_profile(texts: DataFrame) -> DataFrame:
    """Rows and null contents of a text input, counted in one pass."""
    return texts.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("content").isNull()).alias("null_contents")
    )


def check_batch(texts: DataFrame, max_rows: int = MAX_JOB_ROWS) -> None:
    """One job's input: at most `max_rows` rows and no null content."""
    profile = input_profile(texts).first()
    if profile["rows"] > max_rows:
        raise ValueError(f"Batch is too large: {profile['rows']} rows, limit {max_rows}")
    if profile["null_contents"]:
        raise ValueError(f"Null batch inputs detected: {profile['null_contents']}")


def check_contents(texts: DataFrame) -> None:
    """No null content in a scoring input of any size."""
    n_null = texts.agg(F.count_if(F.col("content").isNull()).alias("n")).first()["n"]
    if n_null:
        raise ValueError(f"Null batch inputs detected: {n_null}")
