"""Stages from the listening history to matched songs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playledger import schemas
from playledger.functions.times import week_start, week_window
from playledger.operators.matching import (
    match_search_results,
    match_to_catalogue,
    with_search_text,
)
from playledger.operators.plays import clean_plays
from playledger.operators.queues import searches_not_matched, songs_not_searched
from playledger.operators.recents import recent_albums, recent_artists, recent_tracks
from playledger.operators.responses import answer
from playledger.operators.searches import search_hits
from playledger.plans.tables import Tables
from playledger.sinks.tables import append, merge, merge_partitions
from playledger.sources.records import read_plays, read_recent_plays
from playledger.sources.tables import read_catalogue, table_or_empty

SEARCHES = schemas.SEARCHES + ", hit_pos int"


def merge_plays(plays: DataFrame, table: str) -> int:
    """Cleaned plays into the history, partitioned by week; the key is (url, dt)."""
    weekly = plays.withColumn("week", week_start(F.col("dt")))
    return merge_partitions(weekly, table, ["url", "dt"], "week", order=["song", "artist", "album"])


def load_plays(spark: SparkSession, tables: Tables, path: str, week: str) -> dict[str, int]:
    """One week of plays; running a week again changes nothing."""
    start, end = week_window(week)
    plays = read_plays(spark, path, start, end).transform(clean_plays)
    return {tables.scrobbles: merge_plays(plays, tables.scrobbles)}


def _song_queue(spark: SparkSession, tables: Tables) -> DataFrame:
    return songs_not_searched(
        table_or_empty(spark, tables.scrobbles, schemas.SCROBBLES),
        table_or_empty(spark, tables.matches, schemas.MATCHES),
        table_or_empty(spark, tables.searches, SEARCHES),
    )


def match_catalogue(spark: SparkSession, tables: Tables, catalogue: str) -> dict[str, int]:
    """Unsearched songs matched against the catalogue files at `catalogue`."""
    found = match_to_catalogue(_song_queue(spark, tables), read_catalogue(spark, catalogue))
    return {tables.matches: merge(found, tables.matches, ["song", "artist"])}


def record_searches(spark: SparkSession, tables: Tables, responses: DataFrame) -> dict[str, int]:
    """Answers to the unsearched songs, from `responses(searchtext, hits)`."""
    asked = with_search_text(_song_queue(spark, tables))
    found = search_hits(answer(asked, responses.select("searchtext", "hits"), ["searchtext"]))
    return {tables.searches: append(found, tables.searches)}


def match_searches(spark: SparkSession, tables: Tables) -> dict[str, int]:
    """Recorded searches matched to their hits, best hits first."""
    open_searches = searches_not_matched(
        table_or_empty(spark, tables.searches, SEARCHES),
        table_or_empty(spark, tables.matches, schemas.MATCHES),
    ).withColumn("hit_order", F.struct("hit_pos", "song", "artist"))
    found = match_search_results(open_searches, "hit_order")
    return {tables.matches: merge(found, tables.matches, ["song", "artist"])}


def load_recents(
    spark: SparkSession,
    tables: Tables,
    path: str,
    *,
    before: int | None = None,
    after: int | None = None,
) -> dict[str, int]:
    """Recent plays as merged track, album and artist tables."""
    plays = read_recent_plays(spark, path, before=before, after=after)
    # Tracks keep nearly all fields of a play; albums and artists read one field each.
    parts = {
        "tracks": recent_tracks(read_recent_plays(spark, path, before=before, after=after, whole=True)),
        "albums": recent_albums(plays),
        "artists": recent_artists(plays),
    }
    return {tables.recent(kind): merge(df, tables.recent(kind), ["id"]) for kind, df in parts.items()}
