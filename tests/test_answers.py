"""Answers to a queue: no response is broadcast, each is parsed once, none is read for an empty queue."""

import json

from pyspark.sql import functions as F

from playledger import schemas
from playledger.operators.responses import answer
from playledger.plans import library
from playledger.plans.tables import Tables
from playledger.sources import records


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_responses_are_never_broadcast(spark):
    queue = spark.sql("SELECT * FROM VALUES (1), (2), (null) AS t(id)")
    responses = spark.sql("SELECT * FROM VALUES (1, 'a'), (1, 'b'), (3, 'c'), (null, 'd') AS t(id, body)")
    found = answer(queue, responses, ["id"])
    assert "Broadcast" not in plan(found)
    assert sorted(tuple(r) for r in found.collect()) == [(1, "a"), (1, "b")]


def test_a_record_is_parsed_once_for_all_its_fields(spark):
    bodies = [json.dumps({"id": 1, "title": "a", "stats": 1, "hype": {"x": 2}}), json.dumps({"id": 2}), "{", None]
    given = spark.createDataFrame([(n, b) for n, b in enumerate(bodies)], "n int, body string")
    schema = "id bigint, title string"
    found = records.whole_records(given, "body", schema, "song", dropped=["stats"])
    shown = found.where("song IS NOT NULL").select("n", "song.*")
    optimized = shown._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("from_json(") == 2
    single = given.select("n", records.whole_record(F.col("body"), schema, dropped=["stats"]).alias("song"))
    assert found.orderBy("n").collect() == single.orderBy("n").collect()
    assert shown.where("n = 0").first()["other_fields"] == '{"hype":{"x":2}}'


def test_nothing_asked_reads_no_response(spark, database):
    tables = Tables(listening=database, library=database)
    body = json.dumps({"id": 7, "title": "a", "lyrics_state": "complete"})
    given = spark.createDataFrame([(7, 1, 200, body)], "id bigint, seq bigint, status int, body string")
    spark.createDataFrame([("s", "x", 7, "a", "b", 100)], schemas.MATCHES).write.saveAsTable(tables.matches)
    assert library.load_songs(spark, tables, given)[tables.songs] == 1
    given.write.saveAsTable(f"{database}.given")
    unread = spark.table(f"{database}.given").withColumn("body", F.when(F.col("id") >= 0, F.raise_error(F.lit("a response was read")).cast("string")))
    assert library.load_songs(spark, tables, unread)[tables.songs] == 0
    assert library.recheck_incomplete_songs(spark, tables, unread)[tables.songs] == 0
    assert [r["title"] for r in spark.table(tables.songs).collect()] == ["a"]
