"""Vector clustering, model scoring and integrity checks."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from playledger.operators.checks import (
    embedding_width_check,
    label_centroid_check,
    report,
    trait_check,
)
from playledger.operators.clustering import assign_clusters, cluster_all, cluster_sizes
from playledger.operators.lloyd import lloyd_step
from playledger.operators.numbering import numbered
from playledger.operators.scoring import embed_inline, score_traits
from playledger.operators.upsert import upsert
from queries.registry import query

DIM = 64


def embeddings(read):
    return read("embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("embedding")
    )


def label_means(read):
    """Mean vector of every label, summed per label and position before it is put together."""
    values = read("embeddings").select(
        F.col("label").cast("long").alias("cluster"), F.posexplode("embedding").alias("at", "value")
    )
    means = values.groupBy("cluster", "at").agg(F.avg("value").alias("mean"))
    # DIM rows per label, however many vectors the label has.
    ordered = means.groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct("at", "mean"))).alias("m"))
    return ordered.select("cluster", F.col("m.mean").alias("centroid"))


NEAREST_SQL = """positions AS (SELECT label AS cluster, unnest(embedding)::DOUBLE AS value,
      generate_subscripts(embedding, 1) AS pos FROM embeddings),
    means AS (SELECT cluster, pos, avg(value) AS mean FROM positions GROUP BY ALL),
    centroids AS (SELECT cluster, list(mean ORDER BY pos) AS centroid FROM means GROUP BY cluster),
    assigned AS (SELECT vec_id AS id, CAST(arg_min(cluster, list_distance(embedding::DOUBLE[], centroid)) AS BIGINT) AS cluster
      FROM embeddings, centroids GROUP BY vec_id)"""


@query("M2 M3 S5 F8 F29", f"WITH {NEAREST_SQL} SELECT id, cluster FROM assigned")
def nearest_clusters(read):
    return assign_clusters(embeddings(read), label_means(read))


@query("A1 O1", f"WITH {NEAREST_SQL} SELECT cluster, count(*) AS size FROM assigned GROUP BY 1")
def nearest_cluster_sizes(read):
    return cluster_sizes(assign_clusters(embeddings(read), label_means(read)))


@query(
    "K10 K9 M4",
    f"""WITH {NEAREST_SQL} SELECT id, cluster FROM assigned
    UNION ALL SELECT doc_id, CAST(quality AS BIGINT) FROM labels
    WHERE NOT EXISTS (SELECT 1 FROM assigned WHERE id = doc_id)""",
)
def cluster_labels_merged(read):
    """New labels over the ones stored before; stored labels of other ids stay."""
    stored = read("labels").select(F.col("doc_id").alias("id"), F.col("quality").cast("long").alias("cluster"))
    return upsert(stored, assign_clusters(embeddings(read), label_means(read)), ["id"])


@query(
    "M1 A6",
    f"""WITH {NEAREST_SQL},
    moved AS (SELECT a.cluster, pos, avg(value) AS mean FROM
      (SELECT vec_id AS id, unnest(embedding)::DOUBLE AS value, generate_subscripts(embedding, 1) AS pos FROM embeddings)
      JOIN assigned a USING (id) GROUP BY ALL)
    SELECT c.cluster, CAST(p.pos - 1 AS BIGINT) AS pos, round(coalesce(m.mean, c.centroid[p.pos]), 6) AS mean
    FROM centroids c, (SELECT unnest(range(1, {DIM} + 1)) AS pos) p LEFT JOIN moved m ON m.cluster = c.cluster AND m.pos = p.pos""",
)
def centers_after_a_step(read):
    """One Lloyd step from the mean of every label, over all vectors."""
    moved = lloyd_step(embeddings(read), label_means(read)).select("cluster", F.posexplode("centroid").alias("pos", "mean"))
    return moved.select("cluster", F.col("pos").cast("long").alias("pos"), F.round("mean", 6).alias("mean"))


@query(
    "R3",
    """SELECT l_orderkey, l_linenumber, l_extendedprice,
    row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) - 1 AS row_index FROM lineitem""",
)
def lines_by_price(read):
    """Every order line with its position by price."""
    lines = read("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return numbered(lines, [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber"])


@query("M1 M4 A6")
def refitted_clusters(read):
    labels, _ = cluster_all(embeddings(read))
    return labels


GROUPS = {"OPN": "aeiou", "CON": "bcdfg", "EXT": "hjklm", "AGR": "npqrs", "NEU": "tvwxyz"}


def letter_counts(texts: list[str]) -> list[list[float]]:
    """A deterministic stand-in for the trait model: letters of each group in a text."""
    seen = (Counter(text) for text in texts)
    return [[float(sum(n[c] for c in letters)) for letters in GROUPS.values()] for n in seen]


def counted(letters: str, name: str) -> str:
    return f"CAST(length(regexp_replace(text, '[^{letters}]', '', 'g')) AS DOUBLE) AS {name}"


@query(
    "M5 O3",
    "SELECT doc_id AS id, " + ", ".join(counted(v, k) for k, v in GROUPS.items()) + " FROM documents",
)
def trait_scores(read):
    texts = read("documents").select("doc_id", "text").toDF("id", "content")
    return score_traits(texts, letter_counts)


@query("M9 F8", "SELECT doc_id AS id, " + ", ".join(counted(v, k) for k, v in GROUPS.items()) + " FROM documents")
def inline_embeddings(read):
    texts = read("documents").select("doc_id", "text").toDF("id", "content")
    vectors = embed_inline(texts, letter_counts, dim=len(GROUPS))
    return vectors.select("id", *(F.col("embedding")[i].alias(k) for i, k in enumerate(GROUPS)))


@query(
    "C1 C2 C3 A3",
    """SELECT 'embeddings_have_expected_dim' AS "check", 'lyrics_embed' AS "table", count(*) = 0 AS passed, count(*) AS bad_rows
      FROM embeddings WHERE label = 3
    UNION ALL SELECT 'embeddings_have_expected_dim', 'lyrics_embed_clustering', TRUE, count(*) FROM embeddings WHERE len(embedding) <> 64
    UNION ALL SELECT 'cluster_labels_have_centroids', 'lyrics_clusters', count(*) = 0, count(*)
      FROM embeddings WHERE label NOT IN (SELECT r_regionkey FROM region) OR label = 2
    UNION ALL SELECT 'big5_traits_are_complete', 'lyrics_big5', count(*) = 0, count(*) FROM customer WHERE c_acctbal < 0 OR c_nationkey = 3""",
)
def integrity_report(read):
    """Vectors of one label shortened, labels against region keys, scores with nulls."""
    vectors = read("embeddings")
    short = F.when(F.col("label") == 3, F.slice("embedding", 1, DIM - 1)).otherwise(F.col("embedding"))
    labels = vectors.select(F.nullif(F.col("label"), F.lit(2)).alias("cluster"))
    centroids = read("region").select(F.col("r_regionkey").alias("cluster"))
    balance = F.col("c_acctbal")
    scores = read("customer").select(
        F.when(balance >= 0, balance).alias("OPN"),
        balance.alias("CON"),
        balance.alias("EXT"),
        F.when(F.col("c_nationkey") != 3, balance).alias("AGR"),
        balance.alias("NEU"),
    )
    return report(
        embedding_width_check(vectors.select(short.alias("embedding")), "lyrics_embed", DIM),
        embedding_width_check(vectors, "lyrics_embed_clustering", DIM),
        label_centroid_check(labels, centroids, "lyrics_clusters"),
        trait_check(scores, "lyrics_big5"),
    )
