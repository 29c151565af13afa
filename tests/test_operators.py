import json

import pytest
from pyspark.sql import functions as F

from playledger import schemas
from playledger.functions.vectors import fixed_width
from playledger.operators import checks, clustering, embedding_jobs, normalize, queues, responses
from playledger.operators import scoring, searches, upsert, validate
from playledger.sources.records import parse_embedding_results
from tests.conftest import rows


def test_upsert_replaces_and_adds(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "id int, v string")
    incoming = spark.createDataFrame(
        [(2, "B", 1), (2, "old", 2), (3, "c", 1), (None, "m", 1)], "id int, v string, w int"
    )
    merged = upsert.upsert(target, incoming, ["id"], order=["w"])
    assert rows(merged) == [
        (1, "a", None), (2, "B", 1), (3, "c", 1), (None, "m", 1), (None, "n", None)
    ]


@pytest.mark.parametrize(
    "only_if_changed, actions",
    [(True, {1: "KEEP", 2: "UPDATE", 3: "KEEP", 4: "INSERT"}),
     (False, {1: "UPDATE", 2: "UPDATE", 3: "UPDATE", 4: "INSERT"})],
)
def test_merge_actions(spark, only_if_changed, actions):
    target = spark.createDataFrame([(1, [1.0]), (2, [2.0]), (3, None)], schemas.EMBEDDINGS)
    incoming = spark.createDataFrame(
        [(1, [1.0]), (2, [9.0]), (3, [3.0]), (4, [4.0]), (4, [4.0])], schemas.EMBEDDINGS
    )
    merged = upsert.merge_with_actions(
        target, incoming, "id", "embedding", only_if_changed=only_if_changed
    )
    got = {r["id"]: r for r in merged.collect()}
    assert {i: r["merge_action"] for i, r in got.items()} == actions
    assert got[3]["embedding"] == (None if only_if_changed else [3.0])
    counts = dict(rows(upsert.action_counts(merged)))
    assert counts == ({"INSERT": 1, "UPDATE": 1} if only_if_changed else {"INSERT": 1, "UPDATE": 3})


def test_queues(spark):
    songs = "song string, artist string"
    plays = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x"), ("c", "x")], songs)
    matches = spark.createDataFrame([("a", "x", 1), ("z", "x", None)], songs + ", g_id long")
    asked = spark.createDataFrame([("b", "x"), ("a", "x")], songs)
    assert rows(queues.songs_not_searched(plays, matches, asked)) == [("c", "x")]
    assert rows(queues.searches_not_matched(asked, matches)) == [("b", "x")]
    library = spark.createDataFrame(
        [(1, "complete"), (2, None), (3, "unreleased")], "id long, lyrics_state string"
    )
    assert queues.matches_without_metadata(matches, library).isEmpty()
    assert rows(queues.songs_incomplete(library), "id") == [(2,), (3,)]
    lyrics = spark.createDataFrame([(1, "la"), (2, None)], schemas.LYRICS)
    assert rows(queues.songs_without_lyrics(library, lyrics), "id") == [(3,)]
    done = spark.createDataFrame([(9, [0.0])], schemas.EMBEDDINGS)
    assert rows(queues.lyrics_without(lyrics, done), "id") == [(1,)]
    labels = spark.createDataFrame([(9, 0)], schemas.LABELS)
    assert queues.embeddings_without_cluster(done, labels).isEmpty()


def hit(id, date=(2020, 3, 4), stats=None, state="complete"):
    parts = None if date is None else dict(zip(("year", "month", "day"), date))
    return {"result": {"id": id, "title": f"t{id}", "release_date_components": parts,
                       "stats": stats, "lyrics_state": state}}


def test_search_hits(spark):
    body = json.dumps([
        hit(1, stats={"pageviews": 5, "hot": True}), hit(2, date=None, stats={"hot": False}),
        hit(3, date=(2020, None, 4), stats={}, state="unreleased"),
        hit(4, date=(2020, 2, 30), stats={"pageviews": None}, state=None),
    ])
    df = spark.createDataFrame([("s", "a", body), ("none", "a", "[]")], "song string, artist string, body string")
    found = searches.search_hits(searches.parse_hits(df, "body"))
    got = rows(found.withColumn("d", F.col("g_release_date").cast("string")),
               "song", "g_id", "d", "g_pageviews", "g_lyrics_complete")
    assert got == [
        ("none", None, None, None, None), ("s", 1, "2020-03-04", 5, True), ("s", 2, None, None, True),
        ("s", 3, None, None, False), ("s", 4, None, None, None),
    ]


def answers(spark, *records):
    return spark.createDataFrame(records, "seq int, id long, status int, lyrics string, lyrics_state string")


def test_response_routing(spark):
    ok = answers(spark, (1, 1, 404, None, None), (2, 2, 200, "la", "complete"))
    assert rows(responses.successful(ok), "id") == [(2,)]
    stopped = answers(spark, (1, 1, 200, "la", "c"), (2, 2, 429, None, None), (3, 3, 200, "la", "c"))
    assert rows(responses.successful(stopped), "id") == [(1,)]
    assert rows(responses.until_throttled(ok), "id") == [(1,), (2,)]
    with pytest.raises(Exception, match="without a status"):
        responses.successful(answers(spark, (1, 1, None, None, None))).collect()
    after_stop = answers(spark, (1, 1, 429, None, None), (2, 2, None, None, None))
    assert responses.successful(after_stop).isEmpty()


def test_lyrics_routing(spark):
    df = answers(spark, (1, 1, 200, "la la", None), (2, 2, 200, "", "complete"),
                 (3, 3, 200, None, "complete"), (4, 4, 200, "", "unreleased"), (5, 5, 200, None, None))
    assert rows(responses.lyrics_records(df)) == [(1, "la la"), (2, None), (3, None)]


def test_song_records_trim(spark):
    df = spark.range(1).select(
        F.lit(1).alias("seq"), F.lit(200).alias("status"),
        F.struct(F.lit(1).alias("id"), F.lit("t").alias("title"), F.lit(2).alias("keep"),
                 F.lit(3).alias("stats"), F.lit(3).alias("pyongs_count")).alias("song"),
    )
    assert responses.song_records(df).columns == ["id", "title", "keep"]


SONG = {
    "id": 7, "title": "T", "album": {"id": 1, "name": "A", "artist": {"id": 2, "name": "X"},
                                     "primary_artists": [{"id": 2, "name": "X"}]},
    "primary_artist": {"id": 2, "name": "X"},
    "featured_artists": [{"id": 3, "name": "F"}, {"id": 4, "name": "G"}],
    "custom_performances": [{"label": "Mix", "artists": [{"id": 5, "name": "M"}]},
                            {"label": "Cut", "artists": [{"id": 6, "name": "N"}]}],
    "media": [],
}


def test_normalize(spark):
    df = spark.createDataFrame([SONG], schemas.SONG)
    tables = normalize.normalize(df, "songs", ["id"])
    assert {"songs__album__primary_artists", "songs__custom_performances__artists", "songs__media"} < set(tables)
    root = tables["songs"].first()
    assert (root["album__id"], root["album__artist__name"], root["primary_artist__id"]) == (1, "X", 2)
    featured = tables["songs__featured_artists"].orderBy("_dlt_list_idx").collect()
    assert [(r["id"], r["_dlt_list_idx"]) for r in featured] == [(3, 0), (4, 1)]
    assert {r["_dlt_parent_id"] for r in featured} == {root["_dlt_id"]}
    mixes = {r["label"]: r for r in tables["songs__custom_performances"].collect()}
    people = tables["songs__custom_performances__artists"].collect()
    assert {(r["id"], r["_dlt_parent_id"]) for r in people} == {
        (5, mixes["Mix"]["_dlt_id"]), (6, mixes["Cut"]["_dlt_id"])
    }
    assert {r["_dlt_root_id"] for r in people} == {root["_dlt_id"]}
    assert tables["songs__media"].isEmpty()
    assert normalize.snake_case("PyongsCount") == "pyongs_count"


def test_normalize_scalar_list_and_merge(spark):
    kind = "id long, tags array<string>"
    old = normalize.normalize(spark.createDataFrame([(1, ["a", "b"]), (2, ["c"])], kind), "t", ["id"])
    new = normalize.normalize(spark.createDataFrame([(1, ["z"])], kind), "t", ["id"])
    merged = normalize.merge_normalized(old, new, "t", ["id"])
    assert rows(merged["t"], "id") == [(1,), (2,)]
    assert rows(merged["t__tags"], "value", "_dlt_list_idx") == [("c", 0), ("z", 0)]


GROUPS = [(1, [0.0, 0.0]), (2, [0.1, 0.0]), (3, [10.0, 10.0]), (4, [10.1, 10.0])]


def test_fit_and_assign(spark):
    points = spark.createDataFrame(GROUPS, schemas.EMBEDDINGS)
    labels, centroids = clustering.cluster_all(points, 2, 0)
    got = dict(rows(labels))
    assert got[1] == got[2] != got[3] == got[4]
    assert dict(rows(clustering.cluster_all(points, 2, 0)[0])) == got
    assert [f.dataType.simpleString() for f in labels.schema] == ["bigint", "bigint"]
    assert [f.dataType.simpleString() for f in centroids.schema] == ["bigint", "array<double>"]
    assert rows(clustering.cluster_sizes(labels)) == [(0, 2), (1, 2)]


def test_assign_to_stored(spark):
    centroids = spark.createDataFrame([(1, [10.0, 10.0]), (0, [0.0, 0.0])], schemas.CENTROIDS)
    points = spark.createDataFrame(
        [(1, [0.2, 0.1]), (2, [9.9, 10.0]), (3, [5.0, 5.0]), (4, None)], schemas.EMBEDDINGS
    )
    assert rows(clustering.assign_clusters(points, centroids)) == [(1, 0), (2, 1), (3, 0), (4, None)]
    wrong = spark.createDataFrame([(1, [0.2])], schemas.EMBEDDINGS)
    with pytest.raises(Exception, match="expected 2 values"):
        clustering.assign_clusters(wrong, centroids).collect()


def test_fixed_width(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], schemas.EMBEDDINGS)
    assert rows(df.select("id", fixed_width(F.col("embedding"), 2))) == [(1, [1.0, 2.0]), (2, None)]
    with pytest.raises(Exception, match="expected 3 values"):
        df.select(fixed_width(F.col("embedding"), 3)).collect()


def test_slices():
    import pandas as pd

    batches = [pd.DataFrame({"x": range(5)}), pd.DataFrame({"x": range(4)})]
    assert [len(b) for b in scoring.slices(iter(batches), 8)] == [8, 1]
    assert list(scoring.slices(iter([]), 8)) == []


def halves(texts):
    assert len(texts) <= 8
    return [[0.5] * 5 for _ in texts]


def test_score_traits(spark):
    texts = spark.createDataFrame([(i, f"text {i}") for i in range(9)], "id long, content string").coalesce(1)
    got = rows(scoring.score_traits(texts, halves))
    assert got == [(i, 0.5, 0.5, 0.5, 0.5, 0.5) for i in range(9)]
    assert scoring.score_traits(texts.limit(0), halves).isEmpty()
    bad = spark.createDataFrame([(1, None)], "id long, content string")
    with pytest.raises(Exception, match="Null batch inputs"):
        scoring.score_traits(bad, halves).collect()


def test_embed_inline(spark):
    texts = spark.createDataFrame([(1, "ab"), (2, "c")], "id long, content string")
    embedded = scoring.embed_inline(texts, lambda batch: [[len(t), 0] for t in batch], dim=2)
    assert rows(embedded) == [(1, [2.0, 0.0]), (2, [1.0, 0.0])]


def test_input_checks(spark):
    many = spark.range(101).select("id", F.lit("a").alias("content"))
    with pytest.raises(ValueError, match="too large"):
        validate.check_batch(many)
    with_null = spark.createDataFrame([(1, "a"), (2, None)], "id long, content string")
    for check in (validate.check_batch, validate.check_contents):
        with pytest.raises(ValueError, match="Null batch inputs"):
            check(with_null)
        check(with_null.where("content IS NOT NULL"))
    with pytest.raises(ValueError, match="duplicate"):
        validate.require_unique(with_null.union(with_null), ["id"], "left")


def test_requests(spark):
    texts = spark.createDataFrame([(5, "he|llo", None), (6, "x", "T")], "id long, content string, title string")
    lines = sorted(json.loads(r[0])["key"] for r in embedding_jobs.request_lines(texts).collect())
    assert lines == [5, 6]
    first = json.loads(embedding_jobs.request_lines(texts.where("id = 5"), dim=8).first()[0])
    assert first == {"key": 5, "request": {"output_dimensionality": 8, "content": {
        "parts": [{"text": "title: none | text: hello"}]}}}
    plain = embedding_jobs.with_prompt(texts.drop("title"), "clustering")
    assert rows(plain, "prompt") == [("task: clustering | query: hello",), ("task: clustering | query: x",)]


def test_submission_batches(spark):
    queue = spark.range(1000).select((999 - F.col("id")).alias("id"))
    got = rows(embedding_jobs.submission_batches(queue, 2, 100), "id", "batch")
    assert sorted(got) == [(i, i // 100) for i in range(200)]
    with pytest.raises(ValueError):
        embedding_jobs.submission_batches(queue, 101)


JOBS = "name string, state string, file_name string, has_dest boolean"


def test_job_routing(spark):
    jobs = spark.createDataFrame([
        ("ok", "JOB_STATE_SUCCEEDED", "f1", True), ("nodest", "JOB_STATE_SUCCEEDED", None, False),
        ("nofile", "JOB_STATE_SUCCEEDED", None, True), ("run", "JOB_STATE_RUNNING", None, False),
        ("wait", "JOB_STATE_PENDING", None, False), ("cancel", "JOB_STATE_CANCELLED", None, False),
        ("fail", "JOB_STATE_FAILED", None, False), ("odd", "JOB_STATE_ODD", None, False),
        ("null", None, None, None)], JOBS)
    got = {r["name"]: (r["action"], r["delete"]) for r in embedding_jobs.route_jobs(jobs, True).collect()}
    assert got.pop("ok") == ("extract", True)
    assert got.pop("cancel") == got.pop("fail") == ("skip", True)
    assert set(got.values()) == {("skip", False)}
    assert not embedding_jobs.route_jobs(jobs).where("`delete`").count()
    results = spark.createDataFrame(
        [("1", [0.5], "f1"), ("2", [0.5], "f2")], "id string, embedding array<double>, file_name string")
    assert rows(embedding_jobs.extract_results(jobs, results)) == [(1, [0.5])]


def test_parse_results(spark):
    line = '{"key": "song-1", "response": {"embedding": {"values": [0.5, 0.25]}}}'
    df = spark.createDataFrame([(line,)], "value string")
    assert rows(parse_embedding_results(df)) == [("song-1", [0.5, 0.25])]


def test_refresh_jobs(spark):
    jobs = spark.createDataFrame(
        [("a", "JOB_STATE_RUNNING"), ("b", None), ("c", "JOB_STATE_SUCCEEDED"), ("d", "JOB_STATE_RUNNING")],
        "name string, state string")
    states = spark.createDataFrame(
        [("a", "JOB_STATE_SUCCEEDED", "x"), ("b", "JOB_STATE_FAILED", "x"), ("c", "odd", "x")],
        "name string, state string, dest string")
    assert rows(embedding_jobs.refresh_jobs(jobs, states)) == [
        ("a", "JOB_STATE_SUCCEEDED"), ("b", "JOB_STATE_FAILED"), ("c", "JOB_STATE_SUCCEEDED"), ("d", "JOB_STATE_RUNNING")]
    assert rows(embedding_jobs.refresh_jobs(jobs, states, keep_all=False), "name") == [("a",), ("b",)]
    assert embedding_jobs.trim_jobs(states).columns == ["name", "state"]


def test_checks(spark):
    vectors = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0]), (3, None)], schemas.EMBEDDINGS)
    labels = spark.createDataFrame([(1, 0), (2, 5), (3, None)], schemas.LABELS)
    centroids = spark.createDataFrame([(0, [1.0])], schemas.CENTROIDS)
    traits = spark.createDataFrame([(1, 1.0, 1.0, None, 1.0, 1.0)], schemas.TRAIT_SCORES)
    got = checks.report(
        checks.embedding_width_check(vectors, "e", 2),
        checks.label_centroid_check(labels, centroids, "c"),
        checks.trait_check(traits, "t"),
        checks.trait_check(traits.limit(0), "empty"),
    )
    assert rows(got, "table", "passed", "bad_rows") == [
        ("c", False, 2), ("e", False, 1), ("empty", True, 0), ("t", False, 1)]
