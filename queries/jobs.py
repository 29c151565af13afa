"""Service responses and embedding jobs: `orders` as the response log and the job table."""

from __future__ import annotations

from pyspark.sql import functions as F

from playledger.operators.embedding_jobs import (
    extract_results,
    refresh_jobs,
    route_jobs,
    submission_batches,
    trim_jobs,
)
from playledger.operators.queues import finished_jobs, unfinished_jobs
from playledger.operators.responses import (
    answer,
    lyrics_records,
    song_records,
    successful,
    until_throttled,
)
from queries.registry import query

STATUS_SQL = """CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' AND o_totalprice > 499000 THEN 429
    WHEN o_orderpriority = '5-LOW' THEN 404 ELSE 200 END"""


def response_log(read):
    """Orders in key order as answers: few are throttled, the low-priority ones fail."""
    urgent = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")
    status = (
        F.when(urgent & (F.col("o_totalprice") > 499000), 429)
        .when(F.col("o_orderpriority") == "5-LOW", 404)
        .otherwise(200)
    )
    return read("orders").select(
        F.col("o_orderkey").alias("seq"),
        F.col("o_custkey").alias("id"),
        status.alias("status"),
        "o_orderstatus",
        "o_orderpriority",
        "o_totalprice",
    )


LOG_SQL = f"""log AS (SELECT *, o_orderkey AS seq, o_custkey AS id, {STATUS_SQL} AS status FROM orders),
    heard AS (SELECT * FROM log WHERE seq < coalesce((SELECT min(seq) FROM log WHERE status = 429),
              9223372036854775807))"""


@query("F21", f"WITH {LOG_SQL} SELECT seq, status FROM heard")
def responses_until_throttled(read):
    return until_throttled(response_log(read)).select("seq", "status")


@query("F21", f"WITH {LOG_SQL} SELECT seq, id FROM heard WHERE status = 200")
def successful_responses(read):
    return successful(response_log(read)).select("seq", "id")


@query(
    "F21 F13 S9",
    f"""WITH {LOG_SQL} SELECT id, o_totalprice AS title, c_name AS artist FROM heard
    JOIN customer ON c_custkey = id WHERE status = 200 AND c_acctbal >= 0""",
)
def song_metadata(read):
    """Customers in credit looked up in the response log; unwanted song fields are gone."""
    queue = read("customer").where("c_acctbal >= 0").select(F.col("c_custkey").alias("id"), "c_name")
    song = F.struct(
        F.col("id"),
        F.col("o_totalprice").alias("title"),
        F.col("c_name").alias("artist"),
        F.col("status").alias("stats"),
        F.col("seq").alias("pyongs_count"),
        F.array("seq").alias("song_relationships"),
    )
    stop = until_throttled(response_log(read))
    return song_records(answer(queue, stop, ["id"]).withColumn("song", song))


@query(
    "F22",
    f"""WITH {LOG_SQL} SELECT id, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS lyrics
    FROM heard WHERE status = 200 AND (o_orderstatus <> 'F' OR o_orderpriority = '2-HIGH')""",
)
def lyrics_from_responses(read):
    lyrics = F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).otherwise("")
    state = F.when(F.col("o_orderpriority") == "2-HIGH", "complete").otherwise("unreleased")
    log = response_log(read).withColumns({"lyrics": lyrics, "lyrics_state": state})
    return lyrics_records(log)


STATE_SQL = """CASE o_orderpriority WHEN '1-URGENT' THEN 'JOB_STATE_SUCCEEDED' WHEN '2-HIGH' THEN 'JOB_STATE_RUNNING'
    WHEN '3-MEDIUM' THEN 'JOB_STATE_FAILED' WHEN '5-LOW' THEN 'JOB_STATE_EXPIRED' END"""
JOBS_SQL = f"jobs AS (SELECT 'job-' || o_orderkey AS name, {STATE_SQL} AS state, o_orderstatus, o_custkey FROM orders)"


def job_table(read):
    priority = F.col("o_orderpriority")
    state = (
        F.when(priority == "1-URGENT", "JOB_STATE_SUCCEEDED")
        .when(priority == "2-HIGH", "JOB_STATE_RUNNING")
        .when(priority == "3-MEDIUM", "JOB_STATE_FAILED")
        .when(priority == "5-LOW", "JOB_STATE_EXPIRED")
    )
    return read("orders").select(
        F.concat(F.lit("job-"), "o_orderkey").alias("name"),
        state.alias("state"),
        (F.col("o_orderstatus") != "P").alias("has_dest"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("file-"), "o_custkey")).alias("file_name"),
    )


@query("F17", f"WITH {JOBS_SQL} SELECT name, state FROM jobs WHERE state IS DISTINCT FROM 'JOB_STATE_SUCCEEDED'")
def unfinished_job_rows(read):
    return unfinished_jobs(job_table(read)).select("name", "state")


@query("F17", f"WITH {JOBS_SQL} SELECT name FROM jobs WHERE state = 'JOB_STATE_SUCCEEDED'")
def finished_job_rows(read):
    return finished_jobs(job_table(read)).select("name")


@query(
    "F20",
    f"""WITH {JOBS_SQL} SELECT name,
    CASE WHEN state = 'JOB_STATE_SUCCEEDED' AND o_orderstatus = 'F' THEN 'extract' ELSE 'skip' END AS action,
    coalesce((state = 'JOB_STATE_SUCCEEDED' AND o_orderstatus = 'F') OR state = 'JOB_STATE_FAILED', FALSE) AS "delete"
    FROM jobs""",
)
def routed_jobs(read):
    return route_jobs(job_table(read), delete_finished=True).select("name", "action", "delete")


@query(
    "M7",
    f"""WITH {JOBS_SQL} SELECT c_custkey AS id, c_acctbal AS balance FROM customer WHERE EXISTS
    (SELECT 1 FROM jobs WHERE state = 'JOB_STATE_SUCCEEDED' AND o_orderstatus = 'F' AND o_custkey = c_custkey)""",
)
def extracted_results(read):
    """Results lie in one file per customer; only those of finished jobs are read."""
    results = read("customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.array("c_acctbal").alias("embedding"),
        F.concat(F.lit("file-"), "c_custkey").alias("file_name"),
    )
    found = extract_results(job_table(read), results)
    return found.select("id", F.col("embedding")[0].alias("balance"))


REPORT_SQL = """reported AS (SELECT 'job-' || o_orderkey AS name, 'JOB_STATE_SUCCEEDED' AS state
    FROM orders WHERE o_orderstatus <> 'O')"""


def reported_states(read):
    return read("orders").where("o_orderstatus <> 'O'").select(
        F.concat(F.lit("job-"), "o_orderkey").alias("name"),
        F.lit("JOB_STATE_SUCCEEDED").alias("state"),
        F.col("o_totalprice").alias("completion_stats"),
    )


@query(
    "M8 F14",
    f"""WITH {JOBS_SQL}, {REPORT_SQL} SELECT j.name, coalesce(r.state, j.state) AS state FROM jobs j
    LEFT JOIN reported r ON r.name = j.name AND j.state IS DISTINCT FROM 'JOB_STATE_SUCCEEDED'""",
)
def refreshed_jobs(read):
    jobs = trim_jobs(job_table(read)).select("name", "state")
    return refresh_jobs(jobs, reported_states(read))


@query(
    "M8",
    f"""WITH {JOBS_SQL}, {REPORT_SQL} SELECT r.name, r.state FROM jobs j JOIN reported r ON r.name = j.name
    WHERE j.state IS DISTINCT FROM 'JOB_STATE_SUCCEEDED'""",
)
def refreshed_active_jobs(read):
    jobs = job_table(read).select("name", "state")
    return refresh_jobs(jobs, reported_states(read), keep_all=False)


@query(
    "O2",
    """SELECT doc_id AS id, CAST((row_number() OVER (ORDER BY doc_id) - 1) // 100 AS INTEGER) AS batch
    FROM (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 400)""",
)
def next_submission(read):
    """The next four jobs of one hundred texts each; the limit is what the service takes."""
    queue = read("documents").select(F.col("doc_id").alias("id"))
    return submission_batches(queue, 4)
