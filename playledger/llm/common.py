"""Shared helpers: tables written once in the shared folder, text batches, null-safe joins."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TEXT_BYTES = 2 << 20
"""Text handled at once inside a task; a longer document is handled alone."""


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names; below the warehouse where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/.checkpoints"


def written(df: DataFrame, folder: str | None = None) -> DataFrame:
    """`df` computed once and read back from the shared folder: cuts the lineage durably."""
    spark = df.sparkSession
    path = folder or f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Steps:
    """Tables that the steps of a loop write, each removed once no later step reads it."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folders: list[tuple[DataFrame, str]] = []

    def put(self, df: DataFrame) -> DataFrame:
        path = f"{shared_folder(self.spark)}/step-{uuid.uuid4().hex}"
        self.folders.append((written(df, path), path))
        return self.folders[-1][0]

    def drop(self, *frames: DataFrame | None) -> None:
        """Removes the tables behind `frames`; frames that no step wrote are passed over."""
        for own, path in [f for f in self.folders if any(f[0] is x for x in frames)]:
            discarded(self.spark, path)
            self.folders = [f for f in self.folders if f[0] is not own]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Fewer rows per Arrow batch: texts are long, and a batch is held whole by both sides."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


@contextmanager
def batch_rows(spark: SparkSession, rows: int):
    """Fewer rows per Arrow batch for the actions inside; the session's own setting holds again afterwards."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    own = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, own)


def discarded(spark: SparkSession, folder: str) -> None:
    """Removes a folder of the shared storage that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def null_safe(left: DataFrame, right: DataFrame, *names: str):
    """Join condition that holds for equal values and for two nulls."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def flat_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, one after the other, and n + 1 offsets; a null text is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[edges[0] : edges[-1]], edges - edges[0]


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = TEXT_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cuts batches into runs of rows with some `limit` bytes of text: (rows, bytes, offsets)."""
    for batch in batches:
        data, edges = flat_texts(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(edges, edges[at] + limit, "right")) - 1)
            end = min(end, batch.num_rows)
            yield batch.slice(at, end - at), data[edges[at] : edges[end]], edges[at : end + 1] - edges[at]
            at = end
