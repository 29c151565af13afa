"""Cleaning of raw play records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HISTORY = ("song", "artist", "album", "artist__mbid", "album__mbid", "dt", "url")


def is_now_playing(flag: Column) -> Column:
    """A set flag marks the track playing right now; missing, empty and false do not."""
    return F.coalesce(~F.lower(flag).isin("", "false"), F.lit(False))


def drop_now_playing(plays: DataFrame) -> DataFrame:
    return plays.where(~is_now_playing(F.col("`@attr`.nowplaying")))


def with_play_time(plays: DataFrame) -> DataFrame:
    """`date.uts` (epoch seconds, text or number) becomes the timestamp `dt`."""
    return plays.withColumn("dt", F.timestamp_seconds(F.col("date.uts").cast("long"))).drop("date")


def flatten_text_fields(plays: DataFrame) -> DataFrame:
    """Lift artist and album text and ids to columns and rename `name` to `song`."""
    lifted = {
        "artist": F.col("artist.`#text`"),
        "artist__mbid": F.col("artist.mbid"),
        "album": F.col("album.`#text`"),
        "album__mbid": F.col("album.mbid"),
        "song": F.col("name"),
    }
    kept = [
        F.col(f"`{name}`") for name in plays.columns if name not in {*lifted, "name", "streamable"}
    ]
    return plays.select(*kept, *(column.alias(name) for name, column in lifted.items()))


def clean_plays(plays: DataFrame) -> DataFrame:
    """Raw play records to rows of the listening history: the named columns first, then all others.

    Only the play date and the streamable mark are dropped; images become (size, text), the play
    flag a plain column.
    """
    flat = (
        plays.transform(drop_now_playing)
        .transform(with_play_time)
        .transform(flatten_text_fields)
    )
    if "image" in flat.columns:
        image = F.transform("image", lambda x: F.struct(x["size"].alias("size"), x["#text"].alias("text")))
        flat = flat.withColumn("image", image)
    if "@attr" in flat.columns:
        flat = flat.withColumn("attr__nowplaying", F.col("`@attr`.nowplaying")).drop("@attr")
    return flat.select(*HISTORY, *(F.col(f"`{name}`") for name in flat.columns if name not in HISTORY))
