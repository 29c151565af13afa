"""The weekly load as an incremental file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from playledger.operators.plays import clean_plays
from playledger.plans.listening import merge_plays
from playledger.schemas import PLAY_PAGE
from playledger.sources.records import explode_play_pages


def stream_plays(
    spark: SparkSession, path: str, table: str, checkpoint: str, files_per_batch: int = 1000
) -> StreamingQuery:
    """Merges play pages that arrived under `path` since the last run, then stops.

    The merge by (url, dt) makes a repeated batch harmless, and late plays simply rewrite
    their own week.
    """
    pages = (
        spark.readStream.schema(PLAY_PAGE)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
    )

    def merge_batch(batch: DataFrame, _: int) -> None:
        merge_plays(explode_play_pages(batch).transform(clean_plays), table)

    return (
        pages.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
