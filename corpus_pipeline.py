"""A small training-data pipeline over `documents`: language, near-duplicates, mixture, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playledger.llm import langid, mixing, patterns, prob_minhash
from playledger.llm.common import written
from playledger.llm.queries import held_out


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and those that read like a language not learned; several languages in one text are kept."""
    model = langid.fit(docs, ~held_out(3))
    # other columns travel in a struct, so that none of their names can meet the model's
    rest = F.struct(*[c for c in docs.columns if c != "text"]).alias("rest")
    told = langid.identify(docs.select("text", rest), model, evidence="over")
    kept = told.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("over") >= 0))
    return kept.select(*["text" if c == "text" else F.col("rest").getField(c).alias(c) for c in docs.columns])


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each class of near-duplicates: that of the smallest doc_id, rows without one last."""
    return prob_minhash.one_of_each(docs)


def take_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the mixture of sources says."""
    return mixing.take_mixture(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 4096 tokens."""
    return patterns.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=4096)


STAGES = [
    ("language", keep_known_language),
    ("near_duplicates", keep_one_of_each_group),
    ("mixture", take_mixture),
    ("packing", pack_sequences),
]

#: Tokenizers and likelihoods are not expressible in SQL; tests hold the stages against plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
