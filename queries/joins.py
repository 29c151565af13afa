"""Equi joins and the similarity joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from playledger.functions.text import normalize_title, search_text
from playledger.operators import matching
from playledger.operators.upsert import new_keys
from queries.registry import query
from queries.texts import page_titles


@query(
    "J3 J4",
    """SELECT p_brand, s_nationkey, count(*) AS lines,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS revenue
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    GROUP BY 1, 2""",
)
def revenue_by_brand_and_nation(read):
    """Lines are summed per part and supplier first, so the joins see each pair once."""
    money = F.col("l_extendedprice").cast("decimal(18,2)")
    sold = read("lineitem").groupBy("l_partkey", "l_suppkey").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(money).alias("revenue")
    )
    parts = read("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    suppliers = read("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    joined = sold.join(parts, "l_partkey").join(suppliers, "l_suppkey")
    return joined.groupBy("p_brand", "s_nationkey").agg(
        F.sum("lines").alias("lines"), F.sum("revenue").cast("double").alias("revenue")
    )


@query(
    "J7",
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem LEFT JOIN
    (SELECT p_partkey FROM part WHERE p_size <= 10) ON l_partkey = p_partkey WHERE p_partkey IS NULL""",
)
def lines_without_small_part(read):
    lines = read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    small = read("part").where("p_size <= 10").select(F.col("p_partkey").alias("l_partkey"))
    return new_keys(lines, small, ["l_partkey"]).select(*lines.columns)


def edited_songs(read):
    """Page titles as listened: one character less, one more, or a tag behind them."""
    title = F.col("title")
    cut = F.concat(F.substring(title, 1, 8), F.substr(title, F.lit(10)))
    added = F.concat(F.substring(title, 1, 12), F.lit("x"), F.substr(title, F.lit(13)))
    song = (
        F.when(F.col("lang") == "en", cut)
        .when(F.col("lang") == "fr", added)
        .otherwise(F.concat(title, F.lit(" (Live)")))
    )
    return page_titles(read).select(song.alias("song"), F.col("lang").alias("artist"))


def title_catalogue(read):
    """Distinct page titles; the first page that has one gives its id and artist."""
    first = page_titles(read).groupBy("title").agg(F.min(F.struct("page_id", "lang")).alias("f"))
    songs = first.select(F.col("f.page_id").alias("id"), "title", F.col("f.lang").alias("artist"))
    return songs.withColumn("searchtext", search_text(F.col("title"), F.col("artist")))


TITLES_SQL = r"""titles AS (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
    regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang FROM pages)"""

CLEAN_SQL = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    nfc_normalize({0}), '\(.*\)', ''), '\[.*\]', ''), '(?i)feat\.? .+$', ''), ' - .*$', ''),
    '[\s\x0b\x{{85}}\p{{Z}}]+', ' ', 'g')"""


@query(
    "J1 J9 F16 A5",
    rf"""WITH {TITLES_SQL},
    songs AS (SELECT CASE lang WHEN 'en' THEN substring(title, 1, 8) || substring(title, 10)
        WHEN 'fr' THEN substring(title, 1, 12) || 'x' || substring(title, 13)
        ELSE title || ' (Live)' END AS song, lang AS artist FROM titles),
    asked AS (SELECT song, artist,
        lower(trim(regexp_replace({CLEAN_SQL.format('song')} || ' ' || artist, '[^\p{{L}}\p{{N}}_]', ' ', 'g'))) AS q FROM songs),
    catalogue AS (SELECT min(page_id) AS id, title, arg_min(lang, page_id) AS lang FROM titles GROUP BY title),
    offered AS (SELECT id, title, lang,
        lower(trim(regexp_replace(title || ' ' || lang, '[^\p{{L}}\p{{N}}_]', ' ', 'g'))) AS c FROM catalogue),
    pairs AS (SELECT q, id, c, length(q) + length(c) AS total FROM (SELECT DISTINCT q FROM asked) JOIN offered
        ON q <> '' AND c <> '' AND 200 * abs(length(q) - length(c)) <= 9 * (length(q) + length(c))
        -- counted in bytes, of which a character has at most four
        AND 50 * levenshtein(q, c) <= 9 * (length(q) + length(c))),
    lcs AS (SELECT q, id, total, list_last(list_reduce(
          [[0::BIGINT FOR x IN range(0, length(c) + 1)]]
            || [[unicode(q[i:i])::BIGINT] FOR i IN range(1, length(q) + 1)],
          lambda row, ch: list_reduce([[0::BIGINT]] || [[j] FOR j IN range(1, length(c) + 1)],
             lambda acc, j: acc || [CASE WHEN unicode(c[j[1]:j[1]]) = ch[1] THEN row[j[1]] + 1
                                      ELSE greatest(row[j[1] + 1], acc[-1]) END]))) AS common FROM pairs),
    scored AS (SELECT q, id, (200 * 2 * common + total) // (2 * total) AS sim FROM lcs),
    best AS (SELECT q, id, sim FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY sim DESC, id) AS rk
        FROM scored WHERE sim >= 96) WHERE rk = 1)
    SELECT song, artist, best.id AS g_id, title AS g_title, lang AS g_artist, CAST(sim AS INTEGER) AS match_score
    FROM best JOIN asked USING (q) JOIN offered ON best.id = offered.id""",
)
def songs_matched_to_catalogue(read):
    return matching.match_to_catalogue(edited_songs(read), title_catalogue(read))


def title_hits(read):
    """Five hits for every edited title: itself, its halves, itself reversed, and its page's url."""
    title = F.col("title")
    half = (F.length(title) / 2).cast("int")
    candidates = F.array(
        title,
        F.substring(title, F.lit(1), half),
        F.concat_ws(" ", F.reverse(F.split(title, " "))),
        F.concat(title, F.lit(" "), title),
        F.col("url"),
    )
    song, artist = F.concat(title, F.lit(" (Live)")), F.col("lang")
    hits = page_titles(read).select(
        "page_id",
        song.alias("song"),
        artist.alias("artist"),
        search_text(normalize_title(song), artist).alias("searchtext"),
        F.posexplode(candidates).alias("pos", "g_title"),
    )
    return hits.select(
        "song",
        "artist",
        "searchtext",
        "g_title",
        F.col("artist").alias("g_primary_artist_names"),
        F.when(F.length("g_title") > 0, F.col("page_id") * 5 + F.col("pos")).alias("g_id"),
        F.struct("page_id", "pos").alias("place"),
    )


@query("J2 J6 J10 F15 R1")
def songs_matched_to_search_hits(read):
    return matching.match_search_results(title_hits(read), "place")


@query("J2 A5")
def best_hit_per_title(read):
    pairs = title_hits(read).select(
        F.col("searchtext").alias("title_group"), F.col("searchtext").alias("query"),
        F.col("g_title").alias("candidate"), F.col("g_id").alias("match_id"), "place",
    )
    return matching.best_in_group(pairs, "title_group", "place").drop("title_group")
