"""Pipeline stages keep a table's own columns whatever they are called; rows without an id spread."""

from pyspark.sql import functions as F

import corpus_pipeline
from playledger.llm import mixing

SF = "/root/testdata/sf0.001"
NAMES = ["score", "lang_pred", "n_languages", "over", "rest", "row", "key", "order", "part", "size", "of", "copies", "rows", "copy", "times", "before"]


def crowded(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    own = {name: F.concat(F.lit(f"{name} "), F.col("doc_id").cast("string")) for name in [*NAMES, *(f"__{n}" for n in NAMES)]}
    return docs.withColumns(own)


def test_stages_pass_own_columns_through(spark):
    docs = crowded(spark)
    for stage in (corpus_pipeline.keep_known_language, corpus_pipeline.take_mixture):
        kept = stage(spark, docs, SF)
        assert kept.columns == docs.columns
        held = kept.select([F.col(n) == F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")) for n in docs.columns if n not in ("doc_id", "text", "lang", "source", "n_chars")])
        assert held.count() > 0 and held.distinct().collect() == [(True,) * len(held.columns)]


def test_rows_without_an_id_have_seeds_of_their_own(spark):
    docs = spark.range(3000).selectExpr("cast(null as bigint) as doc_id", "concat('word other ', id) as text", "'a' as source")
    mixed = mixing.mixed_sizes(docs)
    assert mixed.groupBy("copies").count().count() == 2
    taken = mixing.take_mixture(docs)
    assert abs(taken.count() - 4500) <= 2
    assert taken.groupBy("text").count().agg(F.max("count")).first()[0] <= 2
