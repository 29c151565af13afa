"""Joining a work queue with the responses of a service, and routing them by status.

Responses are a table: `seq` (request order), the key, `status` and a payload. Service order
matters in one place only: the first 429 (too many requests) ends the run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOO_MANY = 429

# Song fields that are not stored.
TRIMMED_SONG_FIELDS = (
    "song_relationships",
    "description_annotation",
    "lyrics_marked_complete_by",
    "lyrics_marked_staff_approved_by",
    "verified_annotations_by",
    "verified_contributors",
    "verified_lyrics_by",
    "current_user_metadata",
    "stats",
    "pyongs_count",
)

# Job fields that are not stored.
TRIMMED_JOB_FIELDS = ("dest", "completion_stats", "error", "output_info", "src")


def until_throttled(responses: DataFrame) -> DataFrame:
    """Responses before the first 429 in request order; all of them where there is none.

    The stop position is one number, evaluated as a scalar subquery before the scan.
    """
    stop = responses.where(F.col("status") == TOO_MANY).select(F.min("seq"))
    position = stop.scalar()
    return responses.where(position.isNull() | (F.col("seq") < position))


def successful(responses: DataFrame) -> DataFrame:
    """Responses that count: stopped at a 429, failures skipped.

    A missing status is a failure outside the protocol and fails the job.
    """
    status = F.coalesce(
        F.col("status"), F.raise_error(F.lit("request failed without a status")).cast("int")
    )
    return until_throttled(responses).where(status == 200)


def song_records(responses: DataFrame, payload: str = "song") -> DataFrame:
    """Songs of the successful, non-empty responses without the fields that are not stored."""
    found = successful(responses).where(F.col(payload).isNotNull())
    return found.select(f"{payload}.*").drop(*TRIMMED_SONG_FIELDS)


def lyrics_records(responses: DataFrame) -> DataFrame:
    """(id, lyrics) of the successful responses.

    An empty text of a song with complete lyrics is recorded as null, so that it is not asked
    for again; any other empty text gives no row.
    """
    empty = F.coalesce(F.col("lyrics"), F.lit("")) == ""
    complete = F.coalesce(F.col("lyrics_state") == "complete", F.lit(False))
    return (
        successful(responses)
        .where(~empty | complete)
        .select("id", F.when(~empty, F.col("lyrics")).alias("lyrics"))
    )


def answer(queue: DataFrame, responses: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The queue's responses, found by key.

    Responses carry whole texts, of which Spark knows no size before they are made, so they are
    never broadcast: both sides are shuffled.
    """
    return queue.join(responses.hint("merge"), list(keys))
