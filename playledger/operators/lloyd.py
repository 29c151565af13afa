"""K-means as seeded Lloyd steps: each is one assignment and one sum of vectors per cluster."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playledger.operators.clustering import MAX_ROUNDS, N_CLUSTERS, RANDOM_SEED, TOLERANCE, assign_clusters
from playledger.schemas import CENTROIDS
from playledger.sources.tables import collect_centroids


def start_centers(embeddings: DataFrame, n_clusters: int = N_CLUSTERS, seed: int = RANDOM_SEED) -> DataFrame:
    """(cluster, centroid): the distinct vectors with the smallest seeded hash, so the choice is the same in any layout."""
    known = embeddings.where("embedding IS NOT NULL").select("embedding")
    mark = F.xxhash64(F.lit(seed), "embedding")
    picked = known.select(mark.alias("mark"), "embedding").groupBy("mark").agg(F.any_value("embedding").alias("embedding"))
    rows = picked.orderBy("mark").limit(n_clusters).collect()
    return embeddings.sparkSession.createDataFrame([(i, r["embedding"]) for i, r in enumerate(rows)], CENTROIDS)


def cluster_sums(embeddings: DataFrame, centroids: DataFrame) -> DataFrame:
    """(cluster, at, value, rows): sums of the vectors nearest to each centroid, by position.

    Vectors are summed inside the tasks, so a task sends one row per cluster and position, however many vectors
    a cluster has. Rows without a vector take no part.
    """
    assigned = assign_clusters(embeddings.where("embedding IS NOT NULL"), centroids, keep="embedding")

    def summed(batches):
        sums: dict[int, np.ndarray] = {}
        counts: dict[int, int] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            labels = batch.column("cluster").to_numpy(zero_copy_only=False)
            vectors = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for label in np.unique(labels):
                own = vectors[labels == label]
                sums[label] = sums.get(label, 0.0) + own.sum(axis=0)
                counts[label] = counts.get(label, 0) + len(own)
        for label, total in sums.items():
            n = len(total)
            columns = [np.full(n, label), np.arange(n), total, np.full(n, counts[label])]
            kinds = [pa.int64(), pa.int32(), pa.float64(), pa.int64()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["cluster", "at", "value", "rows"])

    parts = assigned.select("cluster", "embedding").mapInArrow(summed, "cluster long, at int, value double, rows long")
    return parts.groupBy("cluster", "at").agg(F.sum("value").alias("value"), F.sum("rows").alias("rows"))


def lloyd_step(embeddings: DataFrame, centroids: DataFrame) -> DataFrame:
    """(cluster, centroid) after one step: the mean of the vectors nearest to each; one nearest to none stays."""
    means = cluster_sums(embeddings, centroids).select("cluster", "at", (F.col("value") / F.col("rows")).alias("mean"))
    moved = means.groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct("at", "mean"))).alias("m"))
    moved = moved.select("cluster", F.col("m.mean").alias("_moved"))
    return centroids.join(moved, "cluster", "left").select("cluster", F.coalesce("_moved", F.col("centroid").cast("array<double>")).alias("centroid"))


def refit(
    embeddings: DataFrame,
    n_clusters: int = N_CLUSTERS,
    seed: int = RANDOM_SEED,
    max_rounds: int = MAX_ROUNDS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """(cluster, centroid) after steps until no center moves by more than `tolerance`, or `max_rounds`.

    Only the centers reach the driver between steps, so each step reads the embeddings once and has no lineage.
    """
    spark = embeddings.sparkSession
    centers = start_centers(embeddings, n_clusters, seed)
    for _ in range(max_rounds):
        before = collect_centroids(centers)
        after = collect_centroids(lloyd_step(embeddings, centers))
        centers = spark.createDataFrame([(int(c), v.tolist()) for c, v in zip(*after)], CENTROIDS)
        if np.sqrt(((after[1] - before[1]) ** 2).sum(axis=1)).max() <= tolerance:
            break
    return centers
