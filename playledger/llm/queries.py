"""One query per operator, over its whole table, and the SQL that states its result where SQL can."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playledger.llm import (
    brown, host_graph, langid, mixing, patterns, prob_minhash, rp_forest, segment_topk, token_counts, token_files, turn_trie, web_archive,
    whitening,
)
from playledger.llm.common import small_batches, table
from playledger.llm.host_graph import Rule

RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


def held_out(parts: int):
    """True where crc32 of doc_id as text leaves 1; false for a null doc_id."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(parts)) == 1, F.lit(False))


def op1_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prob_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mixed_sizes(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op3_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    return rp_forest.nearest(embeddings, embeddings.filter("vec_id % 100 = 0"), 10)


def op4_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    small_batches(spark)
    model = langid.fit(docs, ~held_out(3))
    told = langid.identify(docs.select("doc_id", "text"), model)
    return told.select("doc_id", held_out(3).alias("held_out"), "lang_pred", "score", "n_languages")


def op5_rans_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_files.token_file_digests(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op6_brown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.score_texts(table(spark, sf_dir, "documents"), held_out(5))


def op7_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patterns.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=4096)


def op8_segment_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = segment_topk.integer_vectors(table(spark, sf_dir, "embeddings"))
    return segment_topk.top_products(vectors, vectors.filter("vec_id % 20 = 0"), 20)


def op9_transducer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


def op10_host_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_graph.judge(table(spark, sf_dir, "pages"), RULES)


def op11_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv_id")
    head = F.pmod(F.crc32(conv.cast("string")), F.lit(6))
    return turn_trie.prefix_trie(table(spark, sf_dir, "conversations"), head, donor=conv - conv % 100)


def op12_shifted_cholesky(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(table(spark, sf_dir, "embeddings"), k=16)


def op13_arc_converter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web_archive.archived_pages(table(spark, sf_dir, "pages"), least=1000)


QUERIES = {
    f.__name__: f
    for f in (
        op1_prob_minhash, op2_pivotal_mix, op3_rp_forest, op4_language_mixture, op5_rans_files, op6_brown_classes,
        op7_pattern_packing, op8_segment_topk, op9_transducer_counts, op10_host_verdicts, op11_turn_trie,
        op12_shifted_cholesky, op13_arc_converter,
    )
}

_TOPK_SQL = """
WITH v AS (
  SELECT DISTINCT ON (vec_id) vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(q.vector, c.vector) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score
  FROM pairs
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

SQL = {"op8_segment_topk": _TOPK_SQL}
