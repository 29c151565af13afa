"""Catalogue matching broadcasts no side of a join, so that no texts meet in the driver."""

from pyspark.sql import functions as F

from playledger.operators.matching import match_to_catalogue


def test_catalogue_matching_broadcasts_nothing(spark, scratch):
    title = F.concat(F.lit("a title of some forty characters, no "), (F.col("id") % 90 + 10).cast("string"))
    songs = spark.range(200).select(title.alias("song"), F.lit("x").alias("artist"))
    titles = spark.range(90).select("id", title.alias("title"), F.lit("x").alias("artist"), F.concat(title, F.lit(" x")).alias("searchtext"))
    for name, df in (("songs", songs), ("titles", titles)):
        df.write.parquet(f"{scratch}/{name}")
    found = match_to_catalogue(spark.read.parquet(f"{scratch}/songs"), spark.read.parquet(f"{scratch}/titles"))
    rows = found.collect()
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == 200 and all(r["match_score"] == 100 and r["song"] == r["g_title"] for r in rows)
