"""Stages that fill the song library: metadata, lyrics and trait scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playledger import schemas
from playledger.operators.normalize import normalize
from playledger.operators.queues import (
    lyrics_without,
    matches_without_metadata,
    songs_incomplete,
    songs_without_lyrics,
)
from playledger.operators.responses import (
    TRIMMED_SONG_FIELDS,
    answer,
    lyrics_records,
    song_records,
)
from playledger.operators.scoring import REQUEST_ROWS, Scorer, score_traits
from playledger.operators.upsert import dedupe
from playledger.plans.tables import Tables
from playledger.sinks.tables import append, merge, merge_nested, staged
from playledger.sources.records import whole_records
from playledger.sources.tables import table_or_empty

SONG_STATE = "id bigint, full_title string, lyrics_state string"


def _store_songs(queue: DataFrame, responses: DataFrame, table: str) -> dict[str, int]:
    """Answers to a queue of song ids, from `responses(id, seq, status, body)`."""
    asked, rows = staged(queue.distinct())
    # Parsed behind the join, so only the answers to the queue are; where nothing is asked, no response is read.
    answers = answer(asked, responses if rows else responses.limit(0), ["id"]).select("seq", "status", "body")
    found = song_records(whole_records(answers, "body", schemas.SONG, "song", dropped=TRIMMED_SONG_FIELDS))
    # Staged once, as every child table reads it.
    songs, _ = staged(dedupe(found, ["id"]))
    return merge_nested(normalize(songs, table, ["id"]), table, ["id"])


def load_songs(spark: SparkSession, tables: Tables, responses: DataFrame) -> dict[str, int]:
    """Metadata of matched songs that have none."""
    queue = matches_without_metadata(
        table_or_empty(spark, tables.matches, schemas.MATCHES),
        table_or_empty(spark, tables.songs, SONG_STATE),
    )
    return _store_songs(queue.select(F.col("g_id").alias("id")), responses, tables.songs)


def recheck_incomplete_songs(
    spark: SparkSession, tables: Tables, responses: DataFrame
) -> dict[str, int]:
    """Metadata again for songs whose lyrics were not complete; run by hand when needed."""
    queue = songs_incomplete(table_or_empty(spark, tables.songs, SONG_STATE))
    return _store_songs(queue.select("id"), responses, tables.songs)


def load_lyrics(spark: SparkSession, tables: Tables, responses: DataFrame) -> dict[str, int]:
    """Lyrics of songs that have none, from `responses(id, seq, status, lyrics)`."""
    queue = songs_without_lyrics(
        table_or_empty(spark, tables.songs, SONG_STATE),
        table_or_empty(spark, tables.lyrics, schemas.LYRICS),
    ).select("id", "lyrics_state")
    found = lyrics_records(answer(queue, responses, ["id"]))
    return {tables.lyrics: append(found, tables.lyrics)}


def score_lyrics(
    spark: SparkSession, tables: Tables, scorer: Scorer, request_rows: int = REQUEST_ROWS
) -> dict[str, int]:
    """Trait scores of lyrics that have none."""
    queue = lyrics_without(
        table_or_empty(spark, tables.lyrics, schemas.LYRICS),
        table_or_empty(spark, tables.traits, schemas.TRAIT_SCORES),
    ).select("id", F.col("lyrics").alias("content"))
    scored = score_traits(queue, scorer, request_rows)
    return {tables.traits: merge(scored, tables.traits, ["id"])}
