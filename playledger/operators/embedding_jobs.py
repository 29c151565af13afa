"""Embedding batch jobs: choosing rows, building requests, refreshing and reading results."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playledger.functions.text import build_prompt
from playledger.operators.queues import unfinished_jobs
from playledger.operators.responses import TRIMMED_JOB_FIELDS
from playledger.operators.validate import MAX_JOB_ROWS
from playledger.schemas import EMBEDDING_DIM

MAX_JOBS = 100
MAX_BROADCAST_FILES = 10_000
MODEL = "gemini-embedding-2"


def submission_batches(queue: DataFrame, n_jobs: int, job_rows: int = MAX_JOB_ROWS) -> DataFrame:
    """The first `n_jobs` jobs of the queue in id order, numbered in `batch`.

    The service takes a fixed number of jobs per run, so at most 100 x 100 rows are numbered.
    """
    if not 0 < n_jobs <= MAX_JOBS:
        raise ValueError(f"1 to {MAX_JOBS} jobs per run")
    if not 0 < job_rows <= MAX_JOB_ROWS:
        raise ValueError(f"1 to {MAX_JOB_ROWS} rows per job")
    first = queue.orderBy("id").limit(n_jobs * job_rows)
    place = F.row_number().over(Window.orderBy("id")) - 1
    return first.withColumn("batch", F.floor(place / job_rows).cast("int"))


def with_prompt(texts: DataFrame, task: str | None = None) -> DataFrame:
    """Adds the prompt; a missing title column or a null title reads `none`."""
    title = F.coalesce(F.col("title"), F.lit("none")) if "title" in texts.columns else F.lit("none")
    return texts.withColumn("prompt", build_prompt(F.col("content"), title, task))


def request_lines(
    texts: DataFrame, task: str | None = None, dim: int = EMBEDDING_DIM, extra: tuple[str, ...] = ()
) -> DataFrame:
    """One JSON request line per text, with `extra` columns carried along."""
    request = F.struct(
        F.lit(dim).alias("output_dimensionality"),
        F.struct(F.array(F.struct(F.col("prompt").alias("text"))).alias("parts")).alias("content"),
    )
    line = F.to_json(F.struct(F.col("id").alias("key"), request.alias("request")))
    return with_prompt(texts, task).select(*extra, line.alias("value"))


def job_records(batches: DataFrame, run: str, display_name: str) -> DataFrame:
    """One pending job row per batch of a submission."""
    name = F.concat(F.lit(f"batches/{run}-"), F.col("batch").cast("string"))
    now = F.current_timestamp()
    none = F.lit(None).cast("timestamp")
    return batches.select("batch").distinct().select(
        name.alias("name"),
        F.lit(display_name).alias("display_name"),
        F.lit("JOB_STATE_PENDING").alias("state"),
        F.lit(MODEL).alias("model"),
        now.alias("create_time"),
        none.alias("start_time"),
        none.alias("end_time"),
        now.alias("update_time"),
    )


def trim_jobs(jobs: DataFrame) -> DataFrame:
    return jobs.drop(*TRIMMED_JOB_FIELDS)


def route_jobs(jobs: DataFrame, delete_finished: bool = False) -> DataFrame:
    """Adds `action` (extract or skip) and `delete` to jobs of (state, file_name, has_dest).

    A succeeded job without a result file is skipped and stays queued; cancelled and failed
    jobs are skipped and may be deleted; running and unknown ones are left alone.
    """
    state = F.col("state")
    usable = (state == "JOB_STATE_SUCCEEDED") & F.col("has_dest") & F.col("file_name").isNotNull()
    usable = F.coalesce(usable, F.lit(False))
    ended = F.coalesce(state.isin("JOB_STATE_CANCELLED", "JOB_STATE_FAILED"), F.lit(False))
    return jobs.withColumns(
        {
            "action": F.when(usable, "extract").otherwise("skip"),
            "delete": (usable | ended) & F.lit(delete_finished),
        }
    )


def refresh_jobs(jobs: DataFrame, states: DataFrame, keep_all: bool = True) -> DataFrame:
    """Jobs with the state last reported for them.

    With `keep_all` finished jobs and those without a report stay as they are; otherwise only
    the unfinished jobs that have a report remain.
    """
    reported = trim_jobs(states)
    active = unfinished_jobs(jobs).select("name")
    fresh = active.join(reported, "name")
    if not keep_all:
        return fresh
    kept = jobs.join(fresh.select("name"), "name", "left_anti")
    return kept.unionByName(fresh, allowMissingColumns=True).select(*jobs.columns)


def extract_results(jobs: DataFrame, results: DataFrame) -> DataFrame:
    """(id, embedding) of the result rows whose file belongs to a job to extract."""
    files = route_jobs(jobs).where("action = 'extract'").select("file_name").distinct()
    wanted = results.join(files, "file_name", "left_semi")
    return wanted.select(F.col("id").cast("long").alias("id"), "embedding")


def files_to_extract(jobs: DataFrame, extracted: DataFrame) -> DataFrame:
    """(name, file_name) of the jobs to extract whose file is not in `extracted` yet.

    `jobs` has (name, state, file_name, has_dest). A job without a name has no folder and is left
    out; a job that reports another file is extracted again.
    """
    wanted = route_jobs(jobs).where("action = 'extract' AND name IS NOT NULL")
    files = wanted.select("name", "file_name").distinct()
    return files.join(extracted.select("name", "file_name"), ["name", "file_name"], "left_anti")


def extract_files(files: DataFrame, n_files: int, results: DataFrame) -> DataFrame:
    """(id, embedding) of `results(id, embedding, file_name, job)` in the given files.

    Up to `MAX_BROADCAST_FILES` file names travel to the scan, which then reads the folders of
    their jobs only; more of them are joined by a shuffle and every folder is read.
    """
    named = files.select(F.col("name").alias("job"), "file_name").where("job IS NOT NULL AND file_name > ''")
    if n_files <= MAX_BROADCAST_FILES:
        named = F.broadcast(named)
    wanted = results.join(named, ["job", "file_name"], "left_semi")
    return wanted.select(F.col("id").cast("long").alias("id"), "embedding")
