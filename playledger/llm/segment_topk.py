"""Exact top-k by inner product, pruned by segment statistics from coarse to fine.

A vector is summarised per segment by its mean and its deviation. For two vectors of given
summaries the distance has a lower bound, and as q.x = (|q|^2 + |x|^2 - d^2) / 2, the inner product an
upper one: the sum over segments of length * mean * mean + deviation * deviation, where the
deviation is the root of the summed squares around the mean.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playledger.llm.common import written

LEVELS = (2, 8)
"""Segments per vector at each resolution, coarse to fine."""
QUERY_ROWS = 1024
BLOCK_ROWS = 16_384
AT_ONCE = (256, 2048)


def integer_vectors(embeddings: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id and floor(scale * x) of each component as double; vectors that are null or hold null
    or non-finite components are left out, and so are rows without an id; of repeated ids one row stays."""
    v = F.col("embedding")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    rows = embeddings.filter(v.isNotNull() & F.coalesce(sound, F.lit(False)) & F.col("vec_id").isNotNull())
    return rows.select("vec_id", whole.alias("vector")).dropDuplicates(["vec_id"])


def _matrix(column: pa.Array) -> np.ndarray:
    if not len(column):
        return np.zeros((0, 1), np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.int64)


def summary(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Columns whose inner product is the upper bound: scaled means, then deviations."""
    columns = []
    for part in np.array_split(vectors.astype(np.float64), min(segments, vectors.shape[1]), axis=1):
        mean = part.mean(1)
        columns.append(mean * np.sqrt(part.shape[1]))
        columns.append(np.sqrt(((part - mean[:, None]) ** 2).sum(1)))
    return np.stack(columns, axis=1)


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products; by floats where every partial sum is below 2**53."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def block_top(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """The k best rows of a block for each query: (query position, row position, score)."""
    tables = [(summary(queries, s), summary(rows, s)) for s in LEVELS]
    best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    floor = np.full(len(queries), np.iinfo(np.int64).min)
    for q0 in range(0, len(queries), AT_ONCE[0]):
        q1 = min(len(queries), q0 + AT_ONCE[0])
        for r0 in range(0, len(rows), AT_ONCE[1]):
            live = np.arange(r0, min(len(rows), r0 + AT_ONCE[1]))
            asked = np.arange(q0, q1)
            for of_queries, of_rows in tables:
                bound = of_queries[asked] @ of_rows[live].T
                open_pairs = bound * (1 + 1e-9) + 1e-6 >= floor[asked, None]
                asked, live = asked[open_pairs.any(1)], live[open_pairs.any(0)]
                if not len(asked) or not len(live):
                    break
            if not len(asked) or not len(live):
                continue
            score = inner_products(queries[asked], rows[live])
            able = (score >= floor[asked, None]) & (query_ids[asked, None] != ids[None, live])
            if k < score.shape[1]:
                hidden = np.where(able, score, np.iinfo(np.int64).min)
                edge = np.partition(hidden, score.shape[1] - k, axis=1)[:, score.shape[1] - k]
                able &= score >= edge[:, None]
            q, r = np.nonzero(able)
            new = (asked[q], live[r], score[q, r])
            q, r, s = (np.concatenate((a, b)) for a, b in zip(best, new))
            order = np.lexsort((ids[r], -s, q))
            q, r, s = q[order], r[order], s[order]
            rank = np.arange(len(q)) - np.searchsorted(q, q)
            best = (q[rank < k], r[rank < k], s[rank < k])
            full = rank == k - 1
            floor[q[full]] = s[full]
    return best


def top_products(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """The `k` rows of highest inner product for each query: query_id, rank, vec_id, score.

    Both frames have vec_id and an integer `vector` of one length, ids once each (see
    `integer_vectors`). Rows and queries are dealt by hash into blocks of bounded size; each pair of a query block
    and a row block is one group, searched by bounds first, and only its k best per query leave
    it. A query never finds its own id; ties go to the smaller vec_id; fewer rows give fewer ranks.
    """
    spark = vectors.sparkSession
    base, asked = written(vectors), written(queries)
    n_blocks = max(1, -(-base.count() // BLOCK_ROWS))
    n_asked = max(1, -(-asked.count() // QUERY_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    dealt = base.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(n_asked - 1)))
    )
    posed = asked.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(n_asked)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    )

    def searched(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        ids, query_ids = mine.column("vec_id").to_numpy(), theirs.column("vec_id").to_numpy()
        found = (np.zeros(0, np.int64),) * 3
        if len(ids) and len(query_ids):
            rows, asked = (_matrix(t.column("vector").combine_chunks()) for t in (mine, theirs))
            found = block_top(ids, rows, query_ids, asked, k)
        return pa.table({"query_id": query_ids[found[0]], "vec_id": ids[found[1]], "score": found[2]})

    keys = ["block", "part"]
    best = dealt.groupBy(*keys).cogroup(posed.groupBy(*keys)).applyInArrow(searched, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
