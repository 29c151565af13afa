"""Stages for embeddings and clusters: refresh, extract, submit and cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playledger import schemas
from playledger.operators.clustering import (
    N_CLUSTERS,
    RANDOM_SEED,
    assign_clusters,
    cluster_all,
)
from playledger.operators.embedding_jobs import (
    extract_files,
    extract_results,
    files_to_extract,
    job_records,
    refresh_jobs,
    request_lines,
    submission_batches,
)
from playledger.operators.queues import embeddings_without_cluster, finished_jobs, lyrics_without
from playledger.operators.validate import check_contents
from playledger.plans.tables import Tables
from playledger.sinks.publish import publish_clustering
from playledger.sinks.tables import append, load, replace, staged, write_clustering
from playledger.sources.records import read_embedding_results, read_job_results
from playledger.sources.tables import read_centroids, read_embeddings, table_or_empty

JOBS_PER_RUN = 4


def refresh_embedding_jobs(
    spark: SparkSession,
    tables: Tables,
    states: DataFrame,
    task: str | None = None,
    keep_all: bool = True,
) -> dict[str, int]:
    """Job table with the states last reported; `keep_all=False` keeps unfinished jobs only."""
    table = tables.jobs(task)
    jobs = table_or_empty(spark, table, schemas.JOBS)
    fresh, rows = staged(refresh_jobs(jobs, states, keep_all))
    replace(fresh, table)
    return {table: rows}


def extract_embeddings(
    spark: SparkSession,
    tables: Tables,
    results_path: str,
    files: DataFrame,
    task: str | None = None,
    format: str = "table",
) -> dict[str, int]:
    """Results of succeeded jobs; `files(name, file_name, has_dest)` says where they are."""
    jobs = finished_jobs(table_or_empty(spark, tables.jobs(task), schemas.JOBS))
    done = jobs.select("name", "state").join(files, "name")
    found = extract_results(done, read_embedding_results(spark, results_path))
    return load(found, tables.embeddings(task), format)


def extract_new_embeddings(
    spark: SparkSession,
    tables: Tables,
    results_path: str,
    files: DataFrame,
    task: str | None = None,
    format: str = "table",
) -> dict[str, int]:
    """As `extract_embeddings`, each result file once, from a folder `job=<name>` per job.

    The files are noted after the load: a run that fails in between loads them again, by key, and
    one that has nothing new reads no results and returns `{}`.
    """
    jobs = finished_jobs(table_or_empty(spark, tables.jobs(task), schemas.JOBS))
    extracted = table_or_empty(spark, tables.extracted(task), schemas.EXTRACTED)
    done = jobs.select("name", "state").join(files, "name")
    fresh, n_files = staged(files_to_extract(done, extracted))
    if not n_files:
        return {}
    found = extract_files(fresh, n_files, read_job_results(spark, results_path))
    counts = load(found, tables.embeddings(task), format)
    append(fresh, tables.extracted(task))
    return counts


def submit_embedding_jobs(
    spark: SparkSession,
    tables: Tables,
    requests_path: str,
    run: str,
    task: str | None = None,
    n_jobs: int = JOBS_PER_RUN,
) -> dict[str, int]:
    """Request files for the next lyrics without an embedding, one folder per job."""
    queue = lyrics_without(
        table_or_empty(spark, tables.lyrics, schemas.LYRICS),
        table_or_empty(spark, tables.embeddings(task), schemas.EMBEDDINGS),
    ).select("id", F.col("lyrics").alias("content"))
    batches, rows = staged(submission_batches(queue, n_jobs))
    if not rows:
        return {}
    check_contents(batches)
    lines = request_lines(batches, task, extra=("batch",))
    lines.write.mode("errorifexists").partitionBy("batch").text(f"{requests_path}/{run}")
    records = job_records(batches, run, f"lyrics-batch-embed-file:{task}")
    return {tables.jobs(task): append(records, tables.jobs(task))}


def cluster_lyrics(
    spark: SparkSession,
    tables: Tables,
    replace_all: bool = False,
    n_clusters: int = N_CLUSTERS,
    seed: int = RANDOM_SEED,
    dim: int = schemas.EMBEDDING_DIM,
    published: bool = False,
) -> dict[str, int]:
    """Clusters all embeddings anew, or labels the new ones by the stored centroids.

    `published` keeps labels and centroids as versions that readers see change at one moment.
    """
    embeddings = read_embeddings(spark, tables.embeddings("clustering"), dim)
    if not replace_all:
        embeddings = embeddings_without_cluster(
            embeddings, table_or_empty(spark, tables.clusters, schemas.LABELS)
        )
    if embeddings.isEmpty():
        return {}
    if replace_all:
        labels, centroids = cluster_all(embeddings, n_clusters, seed)
    else:
        centroids = read_centroids(spark, tables.centroids, dim)
        labels = assign_clusters(embeddings, centroids)
    if published:
        return publish_clustering(
            labels, centroids, tables.clusters, tables.centroids, tables.clustering, replace_all
        )
    return write_clustering(labels, centroids, tables.clusters, tables.centroids, replace_all)
