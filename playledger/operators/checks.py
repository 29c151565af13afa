"""Integrity checks, each one row of (check, table, passed, bad_rows)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playledger.operators.upsert import new_keys
from playledger.schemas import EMBEDDING_DIM, TRAITS


def _verdict(bad: DataFrame, check: str, table: str) -> DataFrame:
    n_bad = F.col("bad_rows")
    return bad.select(
        F.lit(check).alias("check"),
        F.lit(table).alias("table"),
        (n_bad == 0).alias("passed"),
        n_bad,
    )


def embedding_width_check(
    embeddings: DataFrame, table: str, dim: int = EMBEDDING_DIM
) -> DataFrame:
    """Embeddings of the wrong width; a null embedding is not counted."""
    wrong = F.col("embedding").isNotNull() & (F.size("embedding") != dim)
    return _verdict(
        embeddings.agg(F.count_if(wrong).alias("bad_rows")), "embeddings_have_expected_dim", table
    )


def label_centroid_check(labels: DataFrame, centroids: DataFrame, table: str) -> DataFrame:
    """Labels without a centroid; a null label counts.

    Labels are counted per cluster first, so the join sees one row per cluster.
    """
    sizes = labels.groupBy("cluster").agg(F.count(F.lit(1)).alias("rows"))
    orphans = new_keys(sizes, centroids, ["cluster"])
    return _verdict(
        orphans.agg(F.coalesce(F.sum("rows"), F.lit(0).cast("long")).alias("bad_rows")),
        "cluster_labels_have_centroids",
        table,
    )


def trait_check(scores: DataFrame, table: str) -> DataFrame:
    """Score rows that miss any of the five traits."""
    missing = reduce(lambda a, b: a | b, (F.col(trait).isNull() for trait in TRAITS))
    return _verdict(
        scores.agg(F.count_if(missing).alias("bad_rows")), "big5_traits_are_complete", table
    )


def report(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)
