"""Listening history: `events` as raw play pages, cleaned, ranged and merged by week."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from playledger.functions.times import epoch_millis, week_start
from playledger.operators.plays import HISTORY, clean_plays, drop_now_playing, with_play_time
from playledger.operators.recents import recent_albums, recent_artists, recent_tracks
from playledger.operators.upsert import dedupe, upsert
from playledger.schemas import PLAY_PAGE
from playledger.sources.records import explode_play_pages, play_range, recent_range
from queries.registry import query

KEYS = ["url", "dt"]
ORDER = ["song", "artist", "album", "artist__mbid"]


def raw_plays(read):
    """Every event as a JSON page holding one track, read back with the declared schema."""
    device = F.get_json_object("props", "$.k")
    user = F.col("user_id").cast("string")
    track = F.struct(
        F.concat_ws(" ", "event_type", device).alias("name"),
        F.lit("0").alias("streamable"),
        F.concat(F.lit("/"), user, F.lit("/"), device).alias("url"),
        F.struct(
            F.concat(F.lit("user "), user).alias("#text"),
            F.when(F.col("event_type") != "error", device).alias("mbid"),
        ).alias("artist"),
        F.struct(F.col("event_type").alias("#text")).alias("album"),
        F.struct(F.unix_seconds(F.col("ts").cast("timestamp")).cast("string").alias("uts")).alias("date"),
        F.struct(F.when(F.col("event_type") == "view", "true").alias("nowplaying")).alias("@attr"),
    )
    page = F.to_json(F.struct(F.struct(F.array(track).alias("track")).alias("recenttracks")))
    pages = read("events").select("ts", "user_id", "event_type", "props").select(page.alias("body")).select(F.from_json("body", PLAY_PAGE).alias("p"))
    return explode_play_pages(pages.select("p.*"))


def history(read):
    return clean_plays(raw_plays(read)).select(*HISTORY)


def shown(plays):
    """Play time as epoch seconds, so that the result does not depend on a time zone."""
    return plays.withColumn("played", F.unix_seconds("dt")).drop("dt")


RAW_SQL = """
raw AS (
  SELECT event_type || ' ' || (props->>'$.k') AS song, 'user ' || user_id AS artist,
         event_type AS album, CASE WHEN event_type <> 'error' THEN props->>'$.k' END AS artist__mbid,
         CAST(NULL AS VARCHAR) AS album__mbid, '/' || user_id || '/' || (props->>'$.k') AS url,
         CAST(floor(epoch(ts)) AS BIGINT) AS played, event_type
  FROM events),
plays AS (SELECT * EXCLUDE (event_type) FROM raw WHERE event_type <> 'view')"""


@query("F1 S6", f"WITH {RAW_SQL} SELECT song, artist, url, played FROM plays")
def plays_without_now_playing(read):
    kept = with_play_time(drop_now_playing(raw_plays(read)))
    return shown(kept.select(F.col("name").alias("song"), F.col("artist.`#text`").alias("artist"), "url", "dt"))


@query("F1 F2 F3 F30", f"WITH {RAW_SQL} SELECT song, artist, album, artist__mbid, album__mbid, url, played FROM plays")
def cleaned_plays(read):
    return shown(history(read))


@query(
    "S6 F30",
    f"""WITH {RAW_SQL} SELECT song, artist, album, artist__mbid, album__mbid, url, played FROM plays
    WHERE played >= epoch(TIMESTAMP '2024-01-07') AND played < epoch(TIMESTAMP '2024-01-21')""",
)
def plays_in_range(read):
    start, end = (datetime(2024, 1, day, tzinfo=timezone.utc) for day in (7, 21))
    return shown(clean_plays(play_range(raw_plays(read), start, end)).select(*HISTORY))


WEEK_SQL = "CAST(time_bucket(INTERVAL '7 days', make_timestamp(played * 1000000), TIMESTAMP '1970-01-04') AS DATE)"


@query(
    "T1",
    f"""WITH {RAW_SQL} SELECT CAST({WEEK_SQL} AS VARCHAR) AS week, count(*) AS plays,
    count(DISTINCT artist) AS artists FROM plays GROUP BY 1""",
)
def plays_per_week(read):
    weekly = history(read).groupBy(week_start(F.col("dt")).alias("week"))
    counted = weekly.agg(F.count(F.lit(1)).alias("plays"), F.countDistinct("artist").alias("artists"))
    return counted.withColumn("week", F.col("week").cast("string"))


LAST_WEEK_SQL = f"SELECT max({WEEK_SQL}) - 7 FROM plays"


def last_week(plays):
    """First day of the newest week that has ended, as one number of days to compare with."""
    return plays.select((F.date_sub(week_start(F.max("dt")), 7)).alias("week")).scalar()


@query(
    "T2 T3 K4 K13",
    f"""WITH {RAW_SQL},
    weekly AS (SELECT *, {WEEK_SQL} AS week FROM plays),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY url, played
               ORDER BY song, artist, album, artist__mbid NULLS FIRST) AS rk FROM weekly),
    target AS (SELECT * EXCLUDE (rk) FROM ranked WHERE rk = 1),
    incoming AS (SELECT * REPLACE (upper(song) AS song) FROM target WHERE week = ({LAST_WEEK_SQL}))
    SELECT song, artist, album, artist__mbid, album__mbid, url, played, CAST(week AS VARCHAR) AS week
    FROM (SELECT * FROM target t WHERE NOT EXISTS
            (SELECT 1 FROM incoming i WHERE i.url = t.url AND i.played = t.played)
          UNION ALL SELECT * FROM incoming)""",
)
def last_week_merged(read):
    """The history after its last complete week was delivered again with corrected titles."""
    # Written once, as a load stages what it merges: it is read as target and as delivery.
    weekly = history(read).withColumn("week", week_start(F.col("dt"))).checkpoint()
    target = dedupe(weekly, KEYS, ORDER)
    again = weekly.where(F.col("week") == last_week(weekly))
    incoming = dedupe(again, KEYS, ORDER).withColumn("song", F.upper("song"))
    merged = shown(upsert(target, incoming, KEYS))
    return merged.withColumn("week", F.col("week").cast("string"))


@query(
    "T3",
    f"""WITH {RAW_SQL} SELECT song, artist, url, played FROM plays WHERE {WEEK_SQL} = ({LAST_WEEK_SQL})""",
)
def last_week_plays(read):
    plays = history(read)
    week = plays.where(week_start(F.col("dt")) == last_week(plays))
    return shown(week.select("song", "artist", "url", "dt"))


def recent_plays(read):
    """Every line item as a play with one or two artists and an album."""
    artist = F.struct(F.col("l_suppkey").cast("string").alias("id"), F.concat(F.lit("supplier "), "l_suppkey").alias("name"))
    guest = F.struct(
        F.when(F.col("l_returnflag") != "R", F.col("l_partkey").cast("string")).alias("id"),
        F.concat(F.lit("part "), "l_partkey").alias("name"),
    )
    return read("lineitem").select(
        F.when(
            F.col("l_returnflag") != "N", F.concat_ws("-", "l_orderkey", "l_linenumber")
        ).alias("id"),
        F.concat(F.lit("line "), "l_linenumber").alias("name"),
        F.col("l_shipdate").cast("timestamp").alias("played_at"),
        F.when(F.col("l_linestatus") == "O", F.array(artist, guest)).otherwise(F.array(artist)).alias("artists"),
        F.struct(
            F.when(F.col("l_linestatus") == "F", F.col("l_orderkey").cast("string")).alias("id"),
            F.concat(F.lit("order "), "l_orderkey").alias("name"),
            F.array(F.lit("DE")).alias("available_markets"),
        ).alias("album"),
        F.array(F.lit("DE")).alias("available_markets"),
    )


@query(
    "F26 S7",
    """SELECT l_orderkey || '-' || l_linenumber AS id, 'line ' || l_linenumber AS name,
    'supplier ' || l_suppkey AS artist, CAST(l_suppkey AS VARCHAR) AS artist_id,
    'order ' || l_orderkey AS album,
    CASE WHEN l_linestatus = 'F' THEN CAST(l_orderkey AS VARCHAR) END AS album_id,
    CAST(epoch(l_shipdate) AS BIGINT) AS played
    FROM lineitem WHERE l_returnflag <> 'N' AND l_shipdate > TIMESTAMP '1997-06-15'""",
)
def recent_track_rows(read):
    bound = epoch_millis(datetime(1997, 6, 15, tzinfo=timezone.utc))
    tracks = recent_tracks(recent_range(recent_plays(read), after=bound))
    return tracks.withColumn("played", F.unix_seconds("played_at")).drop("played_at")


@query(
    "F27 K5",
    """SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS id, 'order ' || l_orderkey AS name
    FROM lineitem WHERE l_linestatus = 'F'""",
)
def recent_album_rows(read):
    return dedupe(recent_albums(recent_plays(read)), ["id"], ["name"])


@query(
    "F28",
    """SELECT CAST(l_suppkey AS VARCHAR) AS id, 'supplier ' || l_suppkey AS name FROM lineitem
    UNION ALL SELECT CAST(l_partkey AS VARCHAR), 'part ' || l_partkey FROM lineitem
    WHERE l_linestatus = 'O' AND l_returnflag <> 'R'""",
)
def recent_artist_rows(read):
    return recent_artists(recent_plays(read))
