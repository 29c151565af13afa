"""Approximate nearest neighbours: a forest of random-projection trees and exact reranking."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playledger.llm.common import written

TREES = 12
DEPTH = 7
SAMPLE = 1 << 16
PROBES = 180
BLOCK_ROWS = 4096
SEED = 31


@dataclass(frozen=True)
class Forest:
    """Complete trees of one depth: direction (tree, node, dimension) and threshold (tree, node)."""

    directions: np.ndarray
    thresholds: np.ndarray
    depth: int


def build_forest(sample: np.ndarray, depth: int) -> Forest:
    """Splits at the median of a random projection, `depth` times on every path.

    Fewer times on a small sample, so that every split rests on some 16 vectors or more.
    """
    depth = int(min(depth, max(0, np.floor(np.log2(max(1, len(sample)) / 16)))))
    rng = np.random.default_rng(SEED)
    width = sample.shape[1]
    directions = rng.standard_normal((TREES, (1 << depth) - 1, width)).astype(np.float32)
    directions /= np.linalg.norm(directions, axis=2, keepdims=True)
    thresholds = np.zeros((TREES, (1 << depth) - 1), np.float32)
    for tree in range(TREES):
        members = {0: np.arange(len(sample))}
        for node in range((1 << depth) - 1):
            own = members.pop(node)
            along = sample[own] @ directions[tree, node]
            thresholds[tree, node] = np.median(along) if len(own) else 0.0
            right = along > thresholds[tree, node]
            members[2 * node + 1], members[2 * node + 2] = own[~right], own[right]
    return Forest(directions, thresholds, depth)


def leaves(forest: Forest, vectors: np.ndarray) -> np.ndarray:
    """Leaf of each vector in each tree: (vector, tree)."""
    out = np.zeros((len(vectors), len(forest.directions)), np.int64)
    for tree in range(len(forest.directions)):
        node = np.zeros(len(vectors), np.int64)
        for _ in range(forest.depth):
            margin = np.einsum("nd,nd->n", vectors, forest.directions[tree, node]) - forest.thresholds[tree, node]
            node = 2 * node + 1 + (margin > 0)
        out[:, tree] = node - ((1 << forest.depth) - 1)
    return out


def search(forest: Forest, query: np.ndarray, probes: int) -> list[tuple[int, int, int]]:
    """(tree, leaf, place in the queue) of the leaves to visit; one queue is shared by all trees.

    A branch not taken waits with the sum of squares of the margins on its path, a bound on how far the query is from
    the region as far as the directions are at right angles; the nearest region is opened first.
    """
    inner = (1 << forest.depth) - 1
    margins = forest.directions @ query - forest.thresholds if inner else None
    queue = [(0.0, tree, 0) for tree in range(len(forest.directions))]
    found = []
    while queue and len(found) < probes:
        far, tree, node = heapq.heappop(queue)
        while node < inner:
            margin = float(margins[tree, node])
            near = 2 * node + 1 + (margin > 0)
            heapq.heappush(queue, (far + margin * margin, tree, 4 * node + 3 - near))
            node = near
        found.append((tree, node - inner, len(found)))
    return found


def usable(embeddings: DataFrame) -> DataFrame:
    """Rows whose vector takes part: not null, no null or non-finite component, not zero, not empty."""
    v = F.col("embedding")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return embeddings.select("vec_id", v).filter(
        v.isNotNull() & F.coalesce(sound, F.lit(False)) & F.exists(v, lambda x: x != 0)
    )


def matrix(column: pa.Array, kind=np.float64) -> np.ndarray:
    if not len(column):
        return np.zeros((0, 1), kind)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(kind)


def nearest_in_block(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """The k nearest rows of a block for each query: (query position, row position, distance)."""
    out = []
    squares = (rows * rows).sum(1)
    for at in range(0, len(queries), 256):
        part = queries[at : at + 256]
        rough = squares[None] - 2.0 * (part @ rows.T) + (part * part).sum(1)[:, None]
        rough[query_ids[at : at + 256, None] == ids[None]] = np.inf
        last = min(k, rows.shape[0]) - 1
        edge = np.partition(rough, last, axis=1)[:, last]
        edge = edge + 1e-9 * (1.0 + np.abs(edge))
        q, r = np.nonzero((rough <= edge[:, None]) & np.isfinite(rough))
        exact = np.sqrt(((rows[r] - part[q]) ** 2).sum(1))
        order = np.lexsort((ids[r], exact, q))
        q, r, exact = q[order], r[order], exact[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        keep = rank < k
        out.append((q[keep] + at, r[keep], exact[keep]))
    return tuple(np.concatenate(x) for x in zip(*out))


def nearest(
    embeddings: DataFrame, queries: DataFrame, k: int = 10, depth: int = DEPTH, probes: int = PROBES, sample: int = SAMPLE
) -> DataFrame:
    """The `k` nearest found for each row of `queries`: query_id, rank, vec_id, score (distance).

    Both frames have vec_id and embedding; only `usable` vectors of one length take part, a query never
    finds rows of its own vec_id, ties go to the smaller vec_id, and of repeated rows one counts. The forest is fitted on at most some `sample`
    vectors chosen by a hash (all of a smaller table); every vector is indexed in every tree. A leaf
    with many rows is searched in blocks of some BLOCK_ROWS, so copies of one vector spread. On
    vectors without any clusters, recall of 0.9 takes half of all rows as candidates; clustered ones allow
    more depth at the same `probes`.
    """
    spark = embeddings.sparkSession
    base = written(usable(embeddings).filter(F.col("vec_id").isNotNull()).dropDuplicates(["vec_id"]))
    wanted = written(usable(queries).filter(F.col("vec_id").isNotNull()).dropDuplicates(["vec_id"]))
    rows = base.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not rows or wanted.isEmpty():
        return spark.createDataFrame([], schema)
    share = F.pmod(F.xxhash64(F.lit(5), "vec_id"), F.lit(1 << 30)) < int(min(1.0, sample / rows) * (1 << 30))
    fitted = base.filter(share).orderBy("vec_id").select("embedding").toArrow().column(0).combine_chunks()
    forest = build_forest(matrix(fitted, np.float32), depth)

    def indexed(batches):
        for batch in batches:
            values = matrix(batch.column(1), np.float32)
            found = leaves(forest, values)
            n, trees = found.shape
            take = pa.array(np.repeat(np.arange(n), trees))
            tree = np.tile(np.arange(trees, dtype=np.int32), n)
            columns = [pa.array(tree), pa.array(found.reshape(-1).astype(np.int32)), batch.column(0).take(take), batch.column(1).take(take)]
            yield pa.RecordBatch.from_arrays(columns, ["tree", "leaf", "vec_id", "embedding"])

    def visited(batches):
        for batch in batches:
            values = matrix(batch.column(1), np.float32)
            found = [search(forest, v, probes) for v in values]
            take = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
            flat = np.array([x[:2] for f in found for x in f], np.int32).reshape(-1, 2)
            columns = [pa.array(flat[:, 0]), pa.array(flat[:, 1]), batch.column(0).take(take), batch.column(1).take(take)]
            yield pa.RecordBatch.from_arrays(columns, ["tree", "leaf", "vec_id", "embedding"])

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2000)
    of_type = base.schema["embedding"].dataType.simpleString()
    placed = f"tree int, leaf int, vec_id long, embedding {of_type}"
    index = base.mapInArrow(indexed, placed)
    # one row per leaf, of at most TREES * 2**depth
    blocks = written(index.groupBy("tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks")))
    index = _with_blocks(index, blocks).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    visits = _with_blocks(wanted.mapInArrow(visited, placed), blocks).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )

    def compared(mine: pa.Table, asked: pa.Table) -> pa.Table:
        found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        ids, query_ids = mine.column("vec_id").to_numpy(), asked.column("vec_id").to_numpy()
        if len(ids) and len(query_ids):
            vectors = matrix(mine.column("embedding").combine_chunks()), matrix(asked.column("embedding").combine_chunks())
            found = nearest_in_block(ids, vectors[0], query_ids, vectors[1], k)
        return pa.table({"query_id": query_ids[found[0]], "vec_id": ids[found[1]], "score": found[2]})

    keys = ["tree", "leaf", "block"]
    pairs = index.groupBy(*keys).cogroup(visits.groupBy(*keys)).applyInArrow(compared, "query_id long, vec_id long, score double")
    distinct = pairs.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return distinct.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _with_blocks(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    own = blocks.select(F.col("tree").alias("of_tree"), F.col("leaf").alias("of_leaf"), F.col("blocks").alias("blocks"))
    on = (F.col("tree") == F.col("of_tree")) & (F.col("leaf") == F.col("of_leaf"))
    joined = rows.join(F.broadcast(own), on)
    return joined.select(*[F.col(c).alias(c) for c in (*rows.columns, "blocks")])
