"""Stages end to end on small tables, and the writes below them."""

import json

import pytest
from pyspark.sql import functions as F

from playledger import schemas
from playledger.operators.queues import songs_incomplete
from playledger.plans import library, listening, quality, vectors
from playledger.plans.tables import Tables
from playledger.sinks import tables as sinks
from playledger.sources import tables as sources
from playledger.streaming.plays import stream_plays
from tests.conftest import rows


@pytest.fixture()
def tables(database):
    return Tables(listening=database, library=database)


def track(name, artist, url, uts):
    return {"name": name, "url": url, "artist": {"#text": artist, "mbid": ""},
            "album": {"#text": "al", "mbid": ""}, "date": {"uts": str(uts)}}


def write_pages(folder, name, *tracks):
    with open(f"{folder}/{name}.json", "w") as f:
        f.write(json.dumps({"recenttracks": {"track": list(tracks)}}) + "\n")


SUNDAY = 1769299200
WEEK = 7 * 86400


def test_weekly_update(spark, tables, scratch):
    write_pages(scratch, "p1", track("Hello", "World", "u1", SUNDAY), track("Hello (Live)", "World", "u2", SUNDAY + 9),
                track("Unknown", "Band", "u3", SUNDAY + 10), track("Unknown", "Band", "u3", SUNDAY + 10),
                track("Later", "Band", "u4", SUNDAY + WEEK))
    for _ in range(2):
        assert listening.load_plays(spark, tables, scratch, "2026-01-25") == {tables.scrobbles: 3}
    assert listening.load_plays(spark, tables, scratch, "2026-02-01") == {tables.scrobbles: 1}
    assert spark.table(tables.scrobbles).count() == 4

    catalogue = f"{scratch}/catalogue"
    spark.createDataFrame([(1, "Hello", "World"), (2, "Other", "Band")], schemas.CATALOGUE).write.parquet(catalogue)
    assert listening.match_catalogue(spark, tables, catalogue) == {tables.matches: 2}

    hits = [{"result": {"id": 30, "title": "Unknown", "primary_artist_names": "Band"}},
            {"result": {"id": 31, "title": "Nothing", "primary_artist_names": "Who"}}]
    responses = spark.createDataFrame(
        [("Unknown Band", json.dumps(hits)), ("Later Band", "[]")], "searchtext string, body string"
    ).select("searchtext", F.from_json("body", schemas.SEARCH_HITS).alias("hits"))
    assert listening.record_searches(spark, tables, responses) == {tables.searches: 3}
    assert listening.record_searches(spark, tables, responses) == {tables.searches: 0}
    assert listening.match_searches(spark, tables) == {tables.matches: 1}
    assert rows(spark.table(tables.matches), "song", "g_id", "match_score") == [
        ("Hello (Live)", 1, 96), ("Hello", 1, 100), ("Unknown", 30, 100)]

    songs = spark.createDataFrame(
        [(1, 1, 200, json.dumps({"id": 1, "title": "Hello", "lyrics_state": "complete",
                                 "featured_artists": [{"id": 5, "name": "F"}]})),
         (30, 2, 200, json.dumps({"id": 30, "title": "Unknown", "lyrics_state": "unreleased"}))],
        "id long, seq int, status int, body string")
    counts = library.load_songs(spark, tables, songs)
    assert counts[tables.songs] == 2 and counts[f"{tables.songs}__featured_artists"] == 1
    assert library.load_songs(spark, tables, songs)[tables.songs] == 0
    assert rows(songs_incomplete(spark.table(tables.songs)), "id") == [(30,)]
    again = library.recheck_incomplete_songs(spark, tables, songs)
    assert again[tables.songs] == 1 and spark.table(tables.songs).count() == 2

    lyrics = spark.createDataFrame([(1, 1, 200, "la la"), (30, 2, 200, "")],
                                   "id long, seq int, status int, lyrics string")
    assert library.load_lyrics(spark, tables, lyrics) == {tables.lyrics: 1}
    score = lambda texts: [[0.5] * 5 for _ in texts]
    assert library.score_lyrics(spark, tables, score) == {tables.traits: 1}
    assert library.score_lyrics(spark, tables, score) == {tables.traits: 0}


def test_embedding_jobs(spark, tables, scratch):
    spark.createDataFrame([(i, f"text {i}") for i in range(5)] + [(9, None)], schemas.LYRICS).write.saveAsTable(tables.lyrics)
    done = vectors.submit_embedding_jobs(spark, tables, f"{scratch}/requests", "r1", n_jobs=4)
    assert done == {tables.jobs(): 1}
    lines = spark.read.text(f"{scratch}/requests/r1")
    assert lines.count() == 5 and json.loads(lines.first()[0])["request"]["output_dimensionality"] == 768
    states = spark.createDataFrame([("batches/r1-0", "JOB_STATE_SUCCEEDED")], "name string, state string")
    assert vectors.refresh_embedding_jobs(spark, tables, states) == {tables.jobs(): 1}
    (job,) = spark.table(tables.jobs()).collect()
    assert job["state"] == "JOB_STATE_SUCCEEDED"
    with open(f"{scratch}/f1.json", "w") as f:
        for i in range(5):
            f.write(json.dumps({"key": str(i), "response": {"embedding": {"values": [float(i), 1.0]}}}) + "\n")
    files = spark.createDataFrame([("batches/r1-0", "f1.json", True)], "name string, file_name string, has_dest boolean")
    path = f"{scratch}/f1.json"
    assert vectors.extract_embeddings(spark, tables, path, files) == {"INSERT": 5}
    assert vectors.extract_embeddings(spark, tables, path, files) == {"UPDATE": 5}
    assert vectors.extract_embeddings(spark, tables, path, files, format="table-changed") == {}
    with pytest.raises(NotImplementedError):
        vectors.extract_embeddings(spark, tables, path, files, format="other")
    assert vectors.submit_embedding_jobs(spark, tables, f"{scratch}/requests", "r2") == {}


GROUPS = [(1, [0.0, 0.0]), (2, [0.1, 0.0]), (3, [10.0, 10.0]), (4, [10.1, 10.0])]


def test_clustering(spark, tables):
    assert vectors.cluster_lyrics(spark, tables, dim=2) == {}
    embeddings = tables.embeddings("clustering")
    spark.createDataFrame(GROUPS, schemas.EMBEDDINGS).write.saveAsTable(embeddings)
    with pytest.raises(RuntimeError, match="No centroids"):
        vectors.cluster_lyrics(spark, tables, dim=2)
    full = vectors.cluster_lyrics(spark, tables, replace_all=True, n_clusters=2, dim=2)
    assert full == {tables.centroids: 2, tables.clusters: 4}
    centroids = rows(spark.table(tables.centroids))
    spark.createDataFrame([(5, [9.0, 9.0])], schemas.EMBEDDINGS).write.mode("append").saveAsTable(embeddings)
    assert vectors.cluster_lyrics(spark, tables, dim=2) == {tables.clusters: 1}
    assert vectors.cluster_lyrics(spark, tables, dim=2) == {}
    labels = dict(rows(spark.table(tables.clusters)))
    assert len(labels) == 5 and labels[5] == labels[3]
    assert rows(spark.table(tables.centroids)) == centroids
    report = quality.check_tables(spark, tables, dim=2)
    assert {r["passed"] for r in report.collect()} == {True} and report.count() == 4


def test_recents(spark, tables, scratch):
    with open(f"{scratch}/plays.json", "w") as f:
        for at in (1, 2):
            f.write(json.dumps({"id": "t1", "name": "s", "played_at": f"2026-01-25T00:00:0{at}Z",
                                "artists": [{"id": "a1", "name": "x"}], "album": {"id": "b1", "name": "al"}}) + "\n")
    counts = listening.load_recents(spark, tables, scratch, after=SUNDAY * 1000)
    assert set(counts.values()) == {1} and len(counts) == 3


def test_stream_is_incremental(spark, tables, scratch):
    import os

    pages = f"{scratch}/pages"
    os.mkdir(pages)
    write_pages(pages, "p1", track("a", "x", "u1", SUNDAY), track("b", "x", "u2", SUNDAY + WEEK))
    for _ in range(2):
        stream_plays(spark, pages, tables.scrobbles, f"{scratch}/offsets").awaitTermination()
    write_pages(pages, "p2", track("b", "x", "u2", SUNDAY + WEEK), track("c", "x", "u3", SUNDAY + 1))
    stream_plays(spark, pages, tables.scrobbles, f"{scratch}/offsets").awaitTermination()
    assert rows(spark.table(tables.scrobbles), "song") == [("a",), ("b",), ("c",)]


def test_swap_recovery_and_duplicates(spark, tables):
    df = spark.createDataFrame([(1, [1.0]), (1, [1.0])], schemas.EMBEDDINGS)
    name = tables.embeddings()
    with pytest.raises(ValueError, match="duplicate"):
        sinks.load_embeddings(df, name, only_if_changed=False, unique_source=True)
    assert sinks.load_embeddings(df, name, only_if_changed=True) == {"INSERT": 1}
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__next")
    assert sinks.load_embeddings(df, name, only_if_changed=True) == {}
    assert spark.table(name).count() == 1
    with pytest.raises(Exception, match="(?i)merge"):
        sinks.merge_into_catalog(df.limit(1), name, ["id"])
    assert sinks.append(df, name) == 2 and spark.table(name).count() == 3


def test_sources(spark, tables, scratch):
    assert sources.table_or_empty(spark, tables.lyrics, schemas.LYRICS).columns == ["id", "lyrics"]
    for part in "ba":
        spark.createDataFrame([(1, part, "x")], schemas.CATALOGUE).write.parquet(f"{scratch}/{part}")
    files = [f"{scratch}/b", f"{scratch}/a"]
    assert sources.read_parquet_files(spark, files).count() == 2
    assert rows(sources.read_catalogue(spark, files[1])) == [(1, "a", "x", "a x")]
    sources.read_catalogue(spark, files[0]).write.saveAsTable(tables.lyrics)
    assert sources.read_table(spark, tables.lyrics, ["title"]).columns == ["title"]


def test_hot_keys_stay_whole(spark):
    """A third of all rows under one key: queues and merges still give every row."""
    from playledger.operators.queues import searches_not_matched
    from playledger.operators.upsert import upsert

    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    many = spark.range(30_000).select(hot.alias("song"), F.lit("x").alias("artist"), "id")
    known = many.where("song = 0 OR song > 15000").select("song", "artist")
    expected = many.where("song <> 0 AND song <= 15000").count()
    assert searches_not_matched(many, known).count() == expected
    merged = upsert(many.dropDuplicates(["song"]), many, ["song"], order=[F.desc("id")])
    assert merged.count() == 20_001
    assert merged.where("song = 0").first()["id"] == 29_997


def test_undated_plays_survive_a_partition_merge(spark, database):
    from playledger.sinks.tables import merge_partitions

    schema = "url string, dt string, week string"
    merge_partitions(spark.createDataFrame([("a", "1", None), ("b", "1", "w")], schema), f"{database}.plays", ["url"], "week")
    more = spark.createDataFrame([("c", "2", None, "new")], schema + ", extra string")
    assert merge_partitions(more, f"{database}.plays", ["url"], "week") == 1
    stored = spark.table(f"{database}.plays").select("url", "extra", "week").collect()
    assert sorted(map(tuple, stored)) == [("a", None, None), ("b", None, "w"), ("c", "new", None)]


def test_append_finishes_a_swap_and_adds_columns(spark, database):
    from playledger.sinks.tables import append

    table = f"{database}.jobs"
    spark.createDataFrame([("a",)], "name string").write.saveAsTable(f"{table}__next")
    assert append(spark.createDataFrame([("b", 1)], "name string, n int"), table) == 1
    assert sorted(map(tuple, spark.table(table).select("name", "n").collect())) == [("a", None), ("b", 1)]


def test_partition_merge_finishes_a_swap(spark, database):
    from playledger.sinks.tables import merge_partitions

    table, schema = f"{database}.swapped", "url string, dt string, week string"
    merge_partitions(spark.createDataFrame([("a", "1", "v"), ("b", "1", "w")], schema), table, ["url"], "week")
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}__next")
    merge_partitions(spark.createDataFrame([("b", "2", "w")], schema), table, ["url"], "week")
    assert sorted(map(tuple, spark.table(table).collect())) == [("a", "1", "v"), ("b", "2", "w")]


def test_nested_merge_of_nothing_writes_nothing(spark, database, monkeypatch):
    root = f"{database}.nothing_in"
    rows = spark.createDataFrame([(1, "x")], "id long, name string")
    sinks.replace(rows, root)
    monkeypatch.setattr(sinks, "replace", lambda *_: pytest.fail("written"))
    assert sinks.merge_nested({root: rows.limit(0)}, root, ["id"]) == {root: 0}
    assert spark.table(root).count() == 1
