"""The language stage keeps texts in any number of learned languages, and drops those in none."""

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from playledger.llm import langid

SF = "/root/testdata/sf0.01"


def with_more(docs, texts):
    more = docs.sparkSession.createDataFrame(texts, "doc_id long, text string")
    return docs.unionByName(more, allowMissingColumns=True)


def test_a_text_in_three_languages_is_kept_and_junk_is_not(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    part = {r.lang: r.text[:3000] for r in docs.filter("n_chars > 4000").orderBy("doc_id").collect()}
    rng = random.Random(3)
    junk = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(200))
    texts = [(-1, " ".join(part[x] for x in ("en", "fr", "de"))), (-2, " ".join(part[x] for x in ("de", "en", "es", "fr"))), (-3, junk), (-4, "12 ..")]
    texts += [(-5, "Это русский текст, которого модель никогда не видела."), (-6, "Tämä on suomenkielinen teksti, jota malli ei ole nähnyt.")]
    kept = corpus_pipeline.keep_known_language(spark, with_more(docs, texts), SF)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.filter("doc_id < 0").collect()} == {-1, -2}
    assert kept.filter("doc_id >= 0").count() == docs.count()


def test_texts_in_an_unlearned_language_are_dropped(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    hidden = docs.withColumn("lang", F.when(F.col("lang") != "fr", F.col("lang")))
    kept = corpus_pipeline.keep_known_language(spark, hidden, SF)
    assert kept.filter("lang is not null").count() == docs.filter("lang != 'fr'").count()
    assert kept.filter("lang is null").count() <= 0.02 * docs.filter("lang = 'fr'").count()


def test_background_lies_between_own_and_foreign_text():
    counts = np.full((langid.BUCKETS, 2), 0.5)
    counts[:1000, 0] += 100
    counts[500:1500, 1] += 100
    level = langid.background(counts, np.log(counts / counts.sum(0)))
    assert ((level < -np.log(1000)) & (level > -np.log(langid.BUCKETS))).all()
    alone = langid.background(counts[:, :1], np.log(counts[:, :1] / counts[:, :1].sum(0)))
    assert -np.log(langid.BUCKETS) < alone[0] < -np.log(1000)
