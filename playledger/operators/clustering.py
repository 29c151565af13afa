"""K-means clustering of embeddings and assignment to stored centroids."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playledger.functions.vectors import nearest
from playledger.schemas import CENTROIDS
from playledger.sources.tables import collect_centroids

N_CLUSTERS = 7
RANDOM_SEED = 1738
MAX_ROUNDS = 300
TOLERANCE = 1e-4


def fit_clusters(
    embeddings: DataFrame, n_clusters: int = N_CLUSTERS, seed: int = RANDOM_SEED
) -> KMeansModel:
    """Euclidean K-means over (id, embedding), fitted by Spark ML on all rows."""
    points = embeddings.select(array_to_vector("embedding").alias("features"))
    points = points.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return KMeans(k=n_clusters, seed=seed, maxIter=MAX_ROUNDS, tol=TOLERANCE).fit(points)
    finally:
        points.unpersist()


def model_centroids(embeddings: DataFrame, model: KMeansModel) -> DataFrame:
    """(cluster, centroid) of a fitted model; the cluster is the position of its center."""
    rows = [(i, center.tolist()) for i, center in enumerate(model.clusterCenters())]
    return embeddings.sparkSession.createDataFrame(rows, CENTROIDS)


def assign_clusters(embeddings: DataFrame, centroids: DataFrame, keep: str = "id") -> DataFrame:
    """(id, cluster) of every embedding by its nearest stored centroid; ties to the lowest.

    `keep="embedding"` gives the vector, as doubles, in place of its id.
    """
    clusters, centers = collect_centroids(centroids)
    cluster = nearest(F.col("embedding"), centers, clusters)
    kept = F.col("id").cast("long") if keep == "id" else F.col("embedding").cast("array<double>")
    return embeddings.select(kept.alias(keep), cluster.alias("cluster"))


def cluster_all(
    embeddings: DataFrame, n_clusters: int = N_CLUSTERS, seed: int = RANDOM_SEED
) -> tuple[DataFrame, DataFrame]:
    """Labels and centroids of a full clustering.

    Labels come from the fitted centers by the same distance as later assignments.
    """
    centroids = model_centroids(embeddings, fit_clusters(embeddings, n_clusters, seed))
    return assign_clusters(embeddings, centroids), centroids


def cluster_sizes(labels: DataFrame) -> DataFrame:
    return labels.groupBy("cluster").agg(F.count(F.lit(1)).alias("size")).orderBy("cluster")
