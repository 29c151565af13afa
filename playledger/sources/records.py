"""Reads of JSON records: play pages, recent plays and embedding results."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playledger.functions.times import in_range
from playledger.schemas import EMBEDDING_RESULT, OTHER_FIELDS, PLAY, PLAY_PAGE, RECENT_PLAY


def _others(fields: Column, schema: str, dropped: Sequence[str]) -> Column:
    """JSON text of the fields of an object that are neither declared nor dropped; null without any."""
    known = [field.name for field in T.StructType.fromDDL(schema).fields]
    others = F.map_filter(fields, lambda name, value: ~name.isin([*known, *dropped]))
    return F.when(F.size(others) > 0, F.to_json(others))


def whole_record(body: Column, schema: str, dropped: Sequence[str] = ()) -> Column:
    """A JSON object as a struct of its declared fields and `other_fields`.

    `other_fields` is the JSON text of an object with every field that is neither declared nor
    `dropped`, values as they were (keys inside them in order); null where there is none. So nothing is lost when a service
    adds a field. A query that does not read it does not parse for it.
    """
    fields = F.from_json(body, "map<string, variant>")
    return F.from_json(body, schema).withField(OTHER_FIELDS, _others(fields, schema, dropped))


def whole_records(rows: DataFrame, body: str, schema: str, name: str, dropped: Sequence[str] = ()) -> DataFrame:
    """`rows` with their column `body` read as the struct `name`, as `whole_record` reads it.

    For records of which most fields are read: a text is parsed once for them and once for the
    others, however many columns and filters follow, and no filter on them is moved below a join.
    """
    read = F.struct(F.from_json(body, schema).alias("known"), F.from_json(body, "map<string, variant>").alias("fields"))
    whole = F.transform(F.array(read), lambda one: one["known"].withField(OTHER_FIELDS, _others(one["fields"], schema, dropped)))
    return rows.withColumn(name, F.explode(whole)).drop(body)


def explode_play_pages(pages: DataFrame) -> DataFrame:
    """One row per track, with all its fields, of the pages read with the play-page schema."""
    tracks = pages.select(F.explode("recenttracks.track").alias("body"))
    return tracks.select(whole_record(F.col("body"), PLAY).alias("track")).select("track.*")


def play_range(
    plays: DataFrame, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """Raw plays with `start <= date.uts < end`; a play without a date is out of any range."""
    if start is None and end is None:
        return plays
    played = F.timestamp_seconds(F.col("date.uts").cast("long"))
    return plays.where(in_range(played, start, end))


def read_plays(
    spark: SparkSession,
    path: str,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """Raw plays of all result pages under `path`, one JSON document per line."""
    return play_range(explode_play_pages(spark.read.schema(PLAY_PAGE).json(path)), start, end)


def read_recent_plays(
    spark: SparkSession, path: str, *, before: int | None = None, after: int | None = None, whole: bool = False
) -> DataFrame:
    """Recent plays on one side of a bound in epoch milliseconds.

    `whole` is for readers of most fields: each record is parsed once for all of them. Otherwise
    it is parsed for the fields that are read, once for each of them.
    """
    lines = spark.read.text(path)
    if whole:
        plays = whole_records(lines, "value", RECENT_PLAY, "play")
    else:
        plays = lines.select(whole_record(F.col("value"), RECENT_PLAY).alias("play"))
    return recent_range(plays.select("play.*"), before=before, after=after)


def recent_range(
    plays: DataFrame, *, before: int | None = None, after: int | None = None
) -> DataFrame:
    """Plays strictly before or strictly after a bound; exactly one bound must be given."""
    if (before is None) == (after is None):
        raise ValueError("Specify before or after but not both")
    if before is not None:
        return plays.where(F.col("played_at") < F.timestamp_millis(F.lit(before)))
    return plays.where(F.col("played_at") > F.timestamp_millis(F.lit(after)))


def parse_embedding_results(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON result lines to (id, embedding)."""
    parsed = lines.select(F.from_json(column, EMBEDDING_RESULT).alias("r"))
    return parsed.select(
        F.col("r.key").alias("id"), F.col("r.response.embedding.values").alias("embedding")
    )


def read_embedding_results(spark: SparkSession, path: str) -> DataFrame:
    """(id, embedding, file) of every result file under `path`."""
    return _result_rows(spark.read.schema(EMBEDDING_RESULT).json(path))


def read_job_results(spark: SparkSession, path: str) -> DataFrame:
    """(id, embedding, file_name, job) of results in a folder `job=<name>` per job.

    A filter on `job`, also one that a join brings at run time, leaves other folders unread.
    """
    return _result_rows(spark.read.schema(f"{EMBEDDING_RESULT}, job string").json(path), "job")


def _result_rows(results: DataFrame, *kept: str) -> DataFrame:
    return results.select(
        F.col("key").alias("id"),
        F.col("response.embedding.values").alias("embedding"),
        F.col("_metadata.file_name").alias("file_name"),
        *kept,
    )
