"""Recent plays of the second listening source as track, album and artist rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def recent_tracks(plays: DataFrame) -> DataFrame:
    """One row per play with an id: first artist and album by name and id, nested parts dropped."""
    artist = F.try_element_at(F.col("artists"), F.lit(1))
    lifted = {
        "artist": artist["name"],
        "artist_id": artist["id"],
        "album": F.col("album.name"),
        "album_id": F.col("album.id"),
    }
    dropped = {"artists", "album", "available_markets"}
    kept = [name for name in plays.columns if name not in dropped]
    return plays.where("id IS NOT NULL").select(
        *kept, *(column.alias(name) for name, column in lifted.items())
    )


def recent_albums(plays: DataFrame) -> DataFrame:
    """Albums with an id, without their market list."""
    albums = plays.where("album.id IS NOT NULL").select("album.*")
    return albums.drop("available_markets")


def recent_artists(plays: DataFrame) -> DataFrame:
    """One row per artist with an id."""
    return (
        plays.select(F.explode("artists").alias("artist")).select("artist.*").where("id IS NOT NULL")
    )
