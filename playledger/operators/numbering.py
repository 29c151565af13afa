"""Gapless row numbers for tables of any size."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playledger.session import ensure_checkpoint_dir

_PLACE_BITS = 33


def numbered(df: DataFrame, order: Sequence[Column | str], name: str = "row_index", start: int = 0) -> DataFrame:
    """`df` with a long column `name`: the gapless position of each row in `order`, from `start`.

    Rows are dealt by ranges of `order` and sorted inside them, so no task sees the whole table; only the number
    of rows of each range reaches the driver. Rows alike in `order` are split by a hash of the whole row, so a hot
    value does not land in one task; which of two equal rows comes first is open. The numbers are fixed by a
    checkpoint. Nulls come where `order` puts them.
    """
    ensure_checkpoint_dir(df.sparkSession)
    rest = [F.xxhash64(*(F.col(f"`{c}`") for c in df.columns))]
    ranged = df.repartitionByRange(*order, *rest).sortWithinPartitions(*order, *rest)
    # the id is the number of the range, shifted, and the place in it
    placed = ranged.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("at")).checkpoint()
    placed = placed.select("row", F.shiftright("at", _PLACE_BITS).alias("range"), F.col("at").bitwiseAND((1 << _PLACE_BITS) - 1).alias("place"))
    sizes = sorted(tuple(r) for r in placed.groupBy("range").agg(F.count(F.lit(1)).alias("rows")).collect())
    offsets = [0, *accumulate(rows for _, rows in sizes)]
    first = df.sparkSession.createDataFrame(
        [(number, offset + start) for (number, _), offset in zip(sizes, offsets)], "range long, first long"
    )
    whole = placed.join(F.broadcast(first), "range")
    return whole.select("row.*", (F.col("first") + F.col("place")).alias(name))
