"""Search hits of a catalogue service as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playledger.schemas import SEARCH_HITS


def date_of_parts(parts: Column) -> Column:
    """Date from (year, month, day); null when a part is missing or the day does not exist."""
    text = F.format_string("%04d-%02d-%02d", parts["year"], parts["month"], parts["day"])
    known = parts["year"].isNotNull() & parts["month"].isNotNull() & parts["day"].isNotNull()
    return F.when(known, F.try_to_date(text, "yyyy-MM-dd"))


def search_hits(searches: DataFrame, hits: str = "hits") -> DataFrame:
    """One row per hit with nine `g_` columns; a search without hits keeps one row of nulls.

    `hits` is an array of hit records; the other columns (song, artist, searchtext, ...) are
    repeated on each of its rows. `hit_pos` is the place of a hit in its search.
    """
    others = [name for name in searches.columns if name != hits]
    exploded = searches.select(*others, F.posexplode_outer(hits).alias("hit_pos", "hit"))
    result = F.col("hit.result")
    columns = {
        "g_id": result["id"],
        "g_artist_names": result["artist_names"],
        "g_full_title": result["full_title"],
        "g_primary_artist_names": result["primary_artist_names"],
        "g_title": result["title"],
        "g_title_with_featured": result["title_with_featured"],
        "g_release_date": date_of_parts(result["release_date_components"]),
        "g_pageviews": result["stats"]["pageviews"],
        "g_lyrics_complete": result["lyrics_state"] == "complete",
    }
    return exploded.select(
        *others, *(value.alias(name) for name, value in columns.items()), "hit_pos"
    )


def parse_hits(searches: DataFrame, body: str) -> DataFrame:
    """Replaces the JSON text `body` by its array of hits."""
    return searches.withColumn("hits", F.from_json(body, SEARCH_HITS)).drop(body)
