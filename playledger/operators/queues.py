"""Work queues: what a stage still has to do, as a view over the tables already written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playledger.operators.upsert import new_keys

SONG_KEY = ("song", "artist")


def songs_not_searched(plays: DataFrame, matches: DataFrame, searches: DataFrame) -> DataFrame:
    """Distinct songs of the history with neither a match nor a search.

    The distinct comes first: it is pre-aggregated per map task, so the anti joins see each
    song once however often it was played.
    """
    songs = plays.select(*SONG_KEY).distinct()
    return songs.transform(new_keys, matches, SONG_KEY).transform(new_keys, searches, SONG_KEY)


def searches_not_matched(searches: DataFrame, matches: DataFrame) -> DataFrame:
    return new_keys(searches, matches, SONG_KEY)


def matches_without_metadata(matches: DataFrame, songs: DataFrame) -> DataFrame:
    known = songs.select(F.col("id").alias("g_id"))
    return matches.where("g_id IS NOT NULL").transform(new_keys, known, ["g_id"])


def songs_incomplete(songs: DataFrame) -> DataFrame:
    """Songs whose lyrics are not marked complete; an unknown state counts as incomplete."""
    return songs.where(~F.col("lyrics_state").eqNullSafe("complete"))


def songs_without_lyrics(songs: DataFrame, lyrics: DataFrame) -> DataFrame:
    return new_keys(songs, lyrics, ["id"])


def lyrics_without(lyrics: DataFrame, done: DataFrame) -> DataFrame:
    """Known lyrics whose id has no row in `done` (embeddings or trait scores)."""
    return lyrics.where("lyrics IS NOT NULL").transform(new_keys, done, ["id"])


def embeddings_without_cluster(embeddings: DataFrame, labels: DataFrame) -> DataFrame:
    return new_keys(embeddings, labels, ["id"])


def unfinished_jobs(jobs: DataFrame) -> DataFrame:
    """Jobs not known to have succeeded; a null state is kept."""
    return jobs.where(~F.col("state").eqNullSafe("JOB_STATE_SUCCEEDED"))


def finished_jobs(jobs: DataFrame) -> DataFrame:
    return jobs.where(F.col("state") == "JOB_STATE_SUCCEEDED")
