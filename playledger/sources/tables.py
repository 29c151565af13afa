"""Reads of warehouse tables, catalogue files and databases."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playledger.functions.text import search_text
from playledger.functions.vectors import fixed_width
from playledger.schemas import EMBEDDING_DIM, EMBEDDINGS

MAX_CENTROIDS = 100_000


def read_table(spark: SparkSession, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    finish_swap(spark, table)
    df = spark.table(table)
    return df.select(*columns) if columns else df


def finish_swap(spark: SparkSession, table: str) -> None:
    """Completes a replacement that a driver failure left between its drop and its rename."""
    fresh = f"{table}__next"
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(fresh):
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")


def table_or_empty(spark: SparkSession, table: str, schema: str) -> DataFrame:
    """The table, or an empty frame of its schema before the first write."""
    finish_swap(spark, table)
    if spark.catalog.tableExists(table):
        return spark.table(table)
    return spark.createDataFrame([], schema)


def read_embeddings(spark: SparkSession, table: str, dim: int = EMBEDDING_DIM) -> DataFrame:
    """(id, embedding) of a table that may not exist yet; every vector must be `dim` wide."""
    df = table_or_empty(spark, table, EMBEDDINGS)
    return df.select(F.col("id").cast("long"), fixed_width(F.col("embedding"), dim).alias("embedding"))


def read_centroids(spark: SparkSession, table: str, dim: int = EMBEDDING_DIM) -> DataFrame:
    """(cluster, centroid) in cluster order; there must be a table."""
    finish_swap(spark, table)
    if not spark.catalog.tableExists(table):
        raise RuntimeError(f"No centroids found: {table} does not exist")
    return (
        spark.table(table)
        .select("cluster", fixed_width(F.col("centroid"), dim).alias("centroid"))
        .orderBy("cluster")
    )


def collect_centroids(centroids: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Stored cluster ids and their centers. The number of clusters is checked before use."""
    rows = centroids.select("cluster", "centroid").orderBy("cluster").take(MAX_CENTROIDS + 1)
    if not rows:
        raise RuntimeError("No centroids found: the table is empty")
    if len(rows) > MAX_CENTROIDS:
        raise ValueError(f"more than {MAX_CENTROIDS} centroids")
    return np.array([row[0] for row in rows], dtype=np.int64), np.array([row[1] for row in rows])


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Song catalogue with its search text; titles stay as they are."""
    songs = spark.read.parquet(path).select("id", "title", "artist")
    return songs.withColumn("searchtext", search_text(F.col("title"), F.col("artist")))


def read_parquet_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Many parquet files or folders as one table."""
    return spark.read.parquet(*sorted(paths))


def read_database(
    spark: SparkSession, url: str, table: str, columns: Sequence[str] | None = None, **options: str
) -> DataFrame:
    """A database table over JDBC; pass `partitionColumn` and its bounds to read in parallel."""
    df = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    return df.select(*columns) if columns else df
