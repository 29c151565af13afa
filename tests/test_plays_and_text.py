import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from playledger.functions import text, times
from playledger.operators.plays import HISTORY, clean_plays, drop_now_playing
from playledger.operators.recents import recent_albums, recent_artists, recent_tracks
from playledger.schemas import PLAY, RECENT_PLAY
from playledger.sources.records import read_plays, read_recent_plays, whole_record
from tests.conftest import rows

UTC = timezone.utc


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("Plain Title", "Plain Title"),
        ("Song (Remix)", "Song "),
        ("Song [Bonus Track]", "Song "),
        ("Song - Live", "Song"),
        ("Song feat. Artist", "Song "),
        ("Song (feat. X) [Live]", "Song "),
        ("Cafe\u0301", "Caf\u00e9"),
        ("Defeat me", "De"),
        ("Song FEAT Someone", "Song "),
        ("A (b)\nC (d)", "A C (d)"),
        ("wide\u00a0\u2003 blank", "wide blank"),
        (None, None),
    ],
)
def test_normalize_title(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "t string")
    assert df.select(text.normalize_title(F.col("t"))).first()[0] == expected


def test_search_and_match_text(spark):
    assert value(spark, text.search_text(F.lit("a"), F.lit("b"))) == "a b"
    assert value(spark, text.search_text(F.lit(None).cast("string"), F.lit("b"))) is None
    assert value(spark, text.match_text(F.lit("  Hello, WORLD_1! "))) == "hello  world_1"


@pytest.mark.parametrize(
    "content, title, task, expected",
    [
        ("hello", None, None, "title: none | text: hello"),
        ("hello", "Song", None, "title: Song | text: hello"),
        ("he|llo", "So|ng", None, "title: Song | text: hello"),
        ("hello", "Song", "clustering", "task: clustering | query: hello"),
    ],
)
def test_build_prompt(spark, content, title, task, expected):
    title = None if title is None else F.lit(title)
    assert value(spark, text.build_prompt(F.lit(content), title, task)) == expected


def test_build_prompt_rejects_task():
    with pytest.raises(ValueError):
        text.build_prompt(None, task="bogus")


def test_excluded_terms(spark):
    assert value(spark, text.has_excluded_term(F.lit("Song (LIVE)")))
    assert value(spark, text.has_excluded_term(F.lit("Lied (deutsche Übersetzung)")))
    assert not value(spark, text.has_excluded_term(F.lit("Instrumental")))


def play(**changes):
    record = {
        "name": "Weird Fishes",
        "streamable": "0",
        "url": "u",
        "artist": {"#text": "Radiohead", "mbid": "artist-mbid"},
        "album": {"#text": "In Rainbows", "mbid": "album-mbid"},
        "date": {"uts": "1700000000"},
    }
    record.update(changes)
    return record


def test_clean_plays(spark):
    df = spark.createDataFrame([play(), play(artist={"#text": "A"}, album={"#text": "B"})], PLAY)
    got = rows(df.transform(clean_plays).select(*HISTORY).withColumn("dt", F.col("dt").cast("string")))
    assert got == [
        ("Weird Fishes", "A", "B", None, None, "2023-11-14 22:13:20", "u"),
        ("Weird Fishes", "Radiohead", "In Rainbows", "artist-mbid", "album-mbid", "2023-11-14 22:13:20", "u"),
    ]


@pytest.mark.parametrize(
    "attr, kept",
    [(None, 1), ({}, 1), ({"nowplaying": "false"}, 1), ({"nowplaying": ""}, 1), ({"nowplaying": "true"}, 0)],
)
def test_now_playing(spark, attr, kept):
    df = spark.createDataFrame([play(**{"@attr": attr})], PLAY)
    assert df.transform(drop_now_playing).count() == kept


PAGE = """{"recenttracks": {"track": [
 {"name": "a", "url": "u1", "artist": {"#text": "x"}, "album": {"#text": "y"}, "date": {"uts": "1769299200"}},
 {"name": "b", "url": "u2", "artist": {"#text": "x"}, "album": {"#text": "y"}, "date": {"uts": 1769904000}},
 {"name": "c", "url": "u3", "artist": {"#text": "x"}, "album": {"#text": "y"}, "@attr": {"nowplaying": false}, "date": {"uts": "1769299201"}}
]}}""".replace("\n", "")


def test_read_plays_half_open(spark, scratch):
    """The first second of a week belongs to it, the first of the next does not."""
    with open(f"{scratch}/page.json", "w") as f:
        f.write(PAGE + "\n" + PAGE + "\n")
    start, end = times.week_window("2026-01-25")
    assert rows(read_plays(spark, scratch, start, end).distinct(), "name") == [("a",), ("c",)]
    assert read_plays(spark, scratch).count() == 6
    assert read_plays(spark, scratch).transform(drop_now_playing).count() == 6


def test_weeks(spark):
    assert times.week_window("2026-01-25") == (
        datetime(2026, 1, 25, tzinfo=UTC),
        datetime(2026, 2, 1, tzinfo=UTC),
    )
    with pytest.raises(ValueError):
        times.week_window("2026-01-26")
    for day, start in [("2026-01-25", "2026-01-25"), ("2026-01-31", "2026-01-25"), ("2026-02-01", "2026-02-01")]:
        assert str(value(spark, times.week_start(F.lit(day).cast("timestamp")))) == start
    assert times.last_complete_week(datetime(2026, 1, 31, 23, tzinfo=UTC)) is None
    assert times.last_complete_week(datetime(2026, 2, 1, tzinfo=UTC)) == "2026-01-25"
    assert times.epoch_seconds(datetime(2026, 1, 25, tzinfo=UTC)) == 1769299200
    assert times.epoch_millis(datetime(2026, 1, 25, tzinfo=UTC)) == 1769299200000


RECENT = [
    {
        "id": "t1", "name": "song", "artists": [{"id": "a1", "name": "x"}, {"id": None, "name": "y"}],
        "album": {"id": "b1", "name": "al", "available_markets": ["DE"]}, "available_markets": ["DE"],
    },
    {"id": None, "name": "local", "artists": [], "album": {"id": None, "name": "none"}},
]


def test_recent_parts(spark):
    df = spark.createDataFrame(RECENT, RECENT_PLAY)
    assert rows(recent_tracks(df), "id", "name", "artist", "artist_id", "album", "album_id") == [
        ("t1", "song", "x", "a1", "al", "b1")
    ]
    assert rows(recent_albums(df), "id", "name") == [("b1", "al")]
    assert rows(recent_artists(df), "id", "name") == [("a1", "x")]


def test_read_recent_plays(spark, scratch):
    with open(f"{scratch}/plays.json", "w") as f:
        f.write('{"id": "t1", "played_at": "2026-01-25T00:00:01Z"}\n')
        f.write('{"id": "t2", "played_at": "2026-01-25T00:00:03Z"}\n')
    bound = 1769299202000
    assert rows(read_recent_plays(spark, scratch, before=bound), "id") == [("t1",)]
    assert rows(read_recent_plays(spark, scratch, after=bound), "id") == [("t2",)]
    for bounds in ({}, {"before": 1, "after": 2}):
        with pytest.raises(ValueError):
            read_recent_plays(spark, scratch, **bounds)


def test_whole_records_keep_undeclared_fields(spark):
    body = '{"id": 1, "title": "t", "stats": {"a": 1}, "fresh": "1", "n": 1, "deep": {"b": [1, null], "a": 2.5}, "gone": null}'
    df = spark.createDataFrame([(body,), ('{"id": 2}',), ("not json",), (None,)], "body string")
    record = whole_record(F.col("body"), "id bigint, title string", dropped=["stats"])
    got = [tuple(r) for r in df.select(record.alias("r")).select("r.id", "r.title", "r.other_fields").collect()]
    assert got == [
        (1, "t", '{"fresh":"1","n":1,"deep":{"a":2.5,"b":[1,null]},"gone":null}'),
        (2, None, None),
        (None, None, None),
        (None, None, None),
    ]


def test_plays_keep_all_their_fields(spark, scratch):
    track = {"name": "s", "streamable": "0", "url": "u", "mbid": "m", "artist": {"#text": "x"}, "album": {"#text": "y"},
             "image": [{"size": "small", "#text": "i.png"}], "date": {"uts": "1769299200"}, "userloved": 1}
    with open(f"{scratch}/page.json", "w") as f:
        f.write(json.dumps({"recenttracks": {"track": [track, {**track, "@attr": {"nowplaying": "true"}}]}}) + "\n")
    (row,) = read_plays(spark, scratch).transform(clean_plays).collect()
    assert (row.song, row.artist, row.mbid, row.other_fields) == ("s", "x", "m", '{"userloved":1}')
    assert [tuple(i) for i in row.image] == [("small", "i.png")] and row.attr__nowplaying is None
