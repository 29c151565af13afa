"""Token ids of whole documents in entropy-coded files (static rANS), in document order."""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playledger.llm import rans
from playledger.llm.common import shared_folder, small_batches, text_slices, written
from playledger.llm.token_ids import encode_texts

PACKET_IDS = 1 << 20
_CHUNK = (
    "part int, seq int, start long, doc_ids array<bigint>, sizes array<bigint>, ids binary, "
    "symbols array<int>, counts array<bigint>"
)
_PACKET = "part int, seq int, start long, doc_ids array<bigint>, sizes array<bigint>, packet binary"
_DIGEST = "part int, doc_id long, part_start long, n_tokens long, ids_crc32 long"


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str) -> np.ndarray:
    """Writes the ids of `docs(doc_id, text)`, `end_id` after each document, to `folder`.

    Rows are dealt by ranges of doc_id (null first) and sorted, tokenized once into a table of
    the shared folder along with the counts of ids; the counts of all tasks, summed in Spark,
    make the one frequency table (at most one row per vocabulary entry reaches the driver). A
    null or empty text has the end id alone; repeated rows are written each time; other columns
    are ignored. Returns (ids, counts), which a reader needs.
    """
    spark = docs.sparkSession
    small_batches(spark)
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def tokenized(batches):
        part, seq, start, total = TaskContext.get().partitionId(), 0, 0, np.zeros(0, np.int64)
        doc_ids, sizes, parts, held = [], [], [], 0

        def chunk():
            nonlocal seq, start, doc_ids, sizes, parts, held, total
            ids = np.concatenate(parts)
            total = _add(total, np.bincount(ids))
            row = [[part], [seq], [start], [doc_ids], [sizes], [ids.tobytes()], [None], [None]]
            seq, start = seq + 1, start + held
            doc_ids, sizes, parts, held = [], [], [], 0
            return row

        for rows, data, edges in text_slices(batches, "text"):
            count, ids = encode_texts(data, edges, tokenizer_path)
            ids = np.insert(ids.astype(np.uint32), np.cumsum(count), end_id)
            doc_ids += rows.column(0).to_pylist()
            sizes += (count + 1).tolist()
            parts.append(ids)
            held += len(ids)
            if held >= PACKET_IDS:
                yield _batch(chunk(), _CHUNK)
        if held:
            yield _batch(chunk(), _CHUNK)
        symbols = np.flatnonzero(total)
        yield _batch([[part], [-1], [start], [None], [None], [None], [symbols], [total[symbols]]], _CHUNK)

    chunks = written(ordered.mapInArrow(tokenized, _CHUNK))
    sums = (
        chunks.filter("seq < 0")
        .select(F.inline(F.arrays_zip("symbols", "counts")))
        .groupBy("symbols")
        .agg(F.sum("counts").alias("n"))
        .toPandas()
    )
    symbols, counts = sums["symbols"].to_numpy(np.int64), sums["n"].to_numpy(np.int64)

    def encoded(batches):
        table = rans.Table(symbols, counts)
        for batch in batches:
            for row in batch.to_pylist():
                packet = rans.encode(np.frombuffer(row["ids"], np.uint32), table)
                values = [row[k] for k in ("part", "seq", "start", "doc_ids", "sizes")]
                yield _batch([[v] for v in (*values, packet)], _PACKET)

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
    packets = chunks.filter("seq >= 0").select("part", "seq", "start", "doc_ids", "sizes", "ids")
    packets.mapInArrow(encoded, _PACKET).write.option("compression", "none").parquet(f"{folder}/packets")
    small_batches(spark)
    chunks.filter("seq < 0").select("part", F.col("start").alias("n")).coalesce(1).write.parquet(f"{folder}/parts")
    return np.stack((symbols, counts))


def read_token_files(spark, folder: str, symbols_and_counts: np.ndarray) -> DataFrame:
    """Decodes the files of `folder`: doc_id, start, n_tokens, ids_crc32; checksums are verified."""
    symbols, counts = symbols_and_counts

    def decoded(batches):
        table = rans.Table(symbols, counts)
        for batch in batches:
            for row in batch.to_pylist():
                ids = rans.decode(row["packet"], table).astype("<u4")
                sizes = np.array(row["sizes"], np.int64)
                if int(sizes.sum()) != len(ids):
                    raise ValueError("a packet does not hold the ids of its documents")
                ends = np.cumsum(sizes)
                sums = [zlib.crc32(ids[e - s : e]) for s, e in zip(sizes.tolist(), ends.tolist())]
                part = np.full(len(sizes), row["part"])
                yield _batch([part, row["doc_ids"], row["start"] + ends - sizes, sizes, sums], _DIGEST)

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
    packets = spark.read.parquet(f"{folder}/packets").select("part", "start", "doc_ids", "sizes", "packet")
    # one row per task that wrote, so one window over them is small at any size
    parts = spark.read.parquet(f"{folder}/parts").select(
        F.col("part").alias("of_part"),
        (F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"),
    )
    docs = packets.mapInArrow(decoded, _DIGEST)
    return docs.join(F.broadcast(parts), F.col("part") == F.col("of_part")).select(
        "doc_id", (F.col("before") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_file_digests(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Writes token files to a new shared folder and reads them back."""
    folder = f"{shared_folder(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    table = write_token_files(docs, tokenizer_path, end_id, folder)
    return read_token_files(docs.sparkSession, folder, table)


def _add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if len(a) < len(b):
        a, b = b, a
    a = a.copy()
    a[: len(b)] += b
    return a


def _batch(columns: list, ddl: str) -> pa.RecordBatch:
    kinds = {
        "int": pa.int32(),
        "long": pa.int64(),
        "binary": pa.binary(),
        "array<bigint>": pa.list_(pa.int64()),
        "array<int>": pa.list_(pa.int32()),
    }
    fields = [f.split() for f in ddl.split(", ")]
    return pa.record_batch([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])
