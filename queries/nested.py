"""Search hits and nested records built from the columns of single rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from playledger.functions.vectors import fixed_width
from playledger.operators.normalize import count_values, normalize
from playledger.operators.searches import parse_hits, search_hits
from playledger.sources.records import parse_embedding_results
from queries.registry import query


def search_responses(read):
    """Every part as a search: small parts found nothing, the others have two hits, as JSON."""

    def hit(number, month, pageviews):
        return F.struct(
            F.struct(
                (F.col("p_partkey") * 10 + number).alias("id"),
                F.col("p_name").alias("title"),
                F.col("p_brand").alias("primary_artist_names"),
                F.when(F.col("p_type") == "ECONOMY", "complete")
                .when(F.col("p_type") == "LARGE", "unreleased")
                .alias("lyrics_state"),
                F.struct(
                    F.lit(2001).alias("year"), month.alias("month"), F.lit(30).alias("day")
                ).alias("release_date_components"),
                F.struct(pageviews.alias("pageviews"), F.lit(True).alias("hot")).alias("stats"),
            ).alias("result")
        )

    size = F.col("p_size")
    found = F.array(
        hit(1, size % 12 + 1, size), hit(2, F.when(size > 25, 7), F.when(size < 9, size))
    )
    none = F.lit("[]")
    body = F.when(F.col("p_type") == "SMALL", none).otherwise(F.to_json(found))
    return read("part").select(F.col("p_name").alias("song"), F.col("p_partkey").alias("artist"), body.alias("body"))


HITS_SQL = """hits AS (
    SELECT p_name AS song, p_partkey AS artist, n, p_partkey * 10 + n AS g_id, p_name AS g_title,
      p_brand AS g_primary_artist_names,
      CASE WHEN n = 1 THEN CASE WHEN p_size % 12 + 1 <> 2 THEN make_date(2001, p_size % 12 + 1, 30) END
           WHEN p_size > 25 THEN DATE '2001-07-30' END AS d,
      CASE WHEN n = 1 OR p_size < 9 THEN p_size END AS g_pageviews,
      CASE p_type WHEN 'ECONOMY' THEN TRUE WHEN 'LARGE' THEN FALSE END AS g_lyrics_complete
    FROM part, (VALUES (1), (2)) v(n) WHERE p_type <> 'SMALL')"""


@query(
    "F12 F23 F24 S9 F11",
    f"""WITH {HITS_SQL} SELECT song, artist, g_id, g_title, g_primary_artist_names, CAST(d AS VARCHAR) AS g_release_date,
      CAST(g_pageviews AS BIGINT) AS g_pageviews, g_lyrics_complete, CAST(n - 1 AS INTEGER) AS hit_pos FROM hits
    UNION ALL SELECT p_name, p_partkey, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM part WHERE p_type = 'SMALL'""",
)
def search_hit_rows(read):
    found = search_hits(parse_hits(search_responses(read), "body"))
    return found.select(
        "song", "artist", "g_id", "g_title", "g_primary_artist_names",
        F.col("g_release_date").cast("string").alias("g_release_date"),
        "g_pageviews", "g_lyrics_complete", "hit_pos",
    )


@query("S8", "SELECT vec_id AS id, len(embedding) AS dim, round(embedding[1]::DOUBLE, 6) AS first FROM embeddings")
def embedding_result_rows(read):
    """Vectors written as JSON result lines and read back."""
    line = F.to_json(
        F.struct(
            F.col("vec_id").cast("string").alias("key"),
            F.struct(
                F.struct(F.col("embedding").cast("array<double>").alias("values")).alias("embedding")
            ).alias("response"),
        )
    )
    parsed = parse_embedding_results(read("embeddings").select(line.alias("value")))
    vector = fixed_width(F.col("embedding"), 64)
    return parsed.select(
        F.col("id").cast("long").alias("id"),
        F.size(vector).cast("long").alias("dim"),
        F.round(vector[0], 6).alias("first"),
    )


def nested_documents(read):
    """Documents with their lines, and lines with their words."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda line: F.struct(F.md5(line).alias("digest"), F.split(line, " ").alias("words")),
    )
    return read("documents").select("doc_id", "lang", "source", "text").select(
        F.col("doc_id").alias("id"),
        F.struct(F.col("lang"), F.struct(F.col("source").alias("name")).alias("origin")).alias("meta"),
        lines.alias("lines"),
    )


LINES_SQL = """lines AS (SELECT doc_id AS id, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) - 1 AS idx FROM documents)"""


@query("K12", "SELECT doc_id AS id, lang AS meta__lang, source AS meta__origin__name FROM documents")
def normalized_parents(read):
    return normalize(nested_documents(read), "docs", ["id"])["docs"].drop("_dlt_id")


@query("K12 R3", f"WITH {LINES_SQL} SELECT id, CAST(idx AS BIGINT) AS idx, md5(line) AS digest FROM lines")
def normalized_lines(read):
    """Child rows with the key of their root, found through the row ids."""
    tables = normalize(nested_documents(read), "docs", ["id"])
    roots = tables["docs"].select("id", F.col("_dlt_id").alias("_dlt_root_id"))
    lines = tables["docs__lines"].join(roots, "_dlt_root_id")
    return lines.select("id", F.col("_dlt_list_idx").alias("idx"), "digest")


@query(
    "K12",
    f"""WITH {LINES_SQL} SELECT id, CAST(idx AS BIGINT) AS idx, len(string_split(line, ' ')) AS words,
    len(list_distinct(string_split(line, ' '))) AS distinct_words FROM lines""",
)
def normalized_words_per_line(read):
    """Grandchild rows counted per line, found through their parent ids."""
    tables = normalize(nested_documents(read), "docs", ["id"])
    roots = tables["docs"].select("id", F.col("_dlt_id").alias("_dlt_root_id"))
    counted = count_values(tables["docs__lines__words"]).withColumnsRenamed({"rows": "words", "distinct_values": "distinct_words"})
    lines = tables["docs__lines"].select(
        F.col("_dlt_id").alias("_dlt_parent_id"), "_dlt_root_id", F.col("_dlt_list_idx").alias("idx")
    )
    joined = lines.join(counted, "_dlt_parent_id").join(roots, "_dlt_root_id")
    return joined.select("id", "idx", "words", "distinct_words")
