"""The track rows of recent plays parse each record once, and find what the field by field reading finds."""

import json

from playledger.operators.recents import recent_tracks
from playledger.sources.records import read_recent_plays


def test_tracks_parse_a_record_once(spark, scratch):
    play = {"id": "t1", "name": "a", "played_at": "2026-01-25T00:00:01Z", "track_number": 3, "chart": {"rank": 1}, "explicit": "no",
            "artists": [{"id": "a1", "name": "x"}], "album": {"id": "b1", "name": "y", "available_markets": ["DE"]}}
    old = play | {"id": "t2", "played_at": "1969-01-25T00:00:01Z"}
    lines = [json.dumps(p) for p in (play, old, play | {"id": None}, {"id": "t3"}, play | {"id": "t4", "artists": [], "album": None})]
    spark.createDataFrame([(line,) for line in [*lines, "{", "[]", ""]], "value string").write.text(f"{scratch}/plays")
    whole = recent_tracks(read_recent_plays(spark, f"{scratch}/plays", after=0, whole=True))
    assert whole._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 2
    single = recent_tracks(read_recent_plays(spark, f"{scratch}/plays", after=0))
    assert whole.columns == single.columns
    found = sorted(whole.collect(), key=str)
    assert found == sorted(single.collect(), key=str)
    assert [(r["id"], r["artist_id"], r["album_id"], r["other_fields"]) for r in found] == [
        ("t1", "a1", "b1", '{"chart":{"rank":1}}'), ("t4", None, None, '{"chart":{"rank":1}}')]
