"""The integrity report over the written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from playledger import schemas
from playledger.operators.checks import (
    embedding_width_check,
    label_centroid_check,
    report,
    trait_check,
)
from playledger.plans.tables import Tables
from playledger.sources.tables import table_or_empty


def check_tables(
    spark: SparkSession, tables: Tables, dim: int = schemas.EMBEDDING_DIM
) -> DataFrame:
    """One row per check: two embedding widths, labels with centroids, complete traits."""
    plain, clustering = tables.embeddings(), tables.embeddings("clustering")
    return report(
        embedding_width_check(table_or_empty(spark, plain, schemas.EMBEDDINGS), plain, dim),
        embedding_width_check(
            table_or_empty(spark, clustering, schemas.EMBEDDINGS), clustering, dim
        ),
        label_centroid_check(
            table_or_empty(spark, tables.clusters, schemas.LABELS),
            table_or_empty(spark, tables.centroids, schemas.CENTROIDS),
            tables.clusters,
        ),
        trait_check(table_or_empty(spark, tables.traits, schemas.TRAIT_SCORES), tables.traits),
    )
