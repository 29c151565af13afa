"""Queues, keyed merges, dedupe and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from playledger.operators import queues
from playledger.operators.upsert import (
    action_counts,
    first_per_key,
    merge_with_actions,
    upsert,
)
from playledger.operators.validate import duplicate_keys, input_profile
from queries.registry import query


def pairs(read, *flags):
    lines = read("lineitem")
    if flags:
        lines = lines.where(F.col("l_returnflag").isin(*flags))
    return lines.select(F.col("l_partkey").alias("song"), F.col("l_suppkey").alias("artist"))


@query(
    "Q1 D1",
    """SELECT DISTINCT l_partkey AS song, l_suppkey AS artist FROM lineitem l
    WHERE NOT EXISTS (SELECT 1 FROM lineitem m WHERE m.l_returnflag = 'R'
                      AND m.l_partkey = l.l_partkey AND m.l_suppkey = l.l_suppkey)
      AND NOT EXISTS (SELECT 1 FROM lineitem s WHERE s.l_returnflag = 'A'
                      AND s.l_partkey = l.l_partkey AND s.l_suppkey = l.l_suppkey)""",
)
def songs_not_searched(read):
    return queues.songs_not_searched(pairs(read), pairs(read, "R"), pairs(read, "A"))


@query(
    "Q2",
    """SELECT l_partkey AS song, l_suppkey AS artist FROM lineitem l WHERE l_returnflag = 'A'
    AND NOT EXISTS (SELECT 1 FROM lineitem m WHERE m.l_returnflag = 'R'
                    AND m.l_partkey = l.l_partkey AND m.l_suppkey = l.l_suppkey)""",
)
def searches_not_matched(read):
    return queues.searches_not_matched(pairs(read, "A"), pairs(read, "R"))


@query(
    "Q3",
    """SELECT doc_id AS g_id, source AS g_artist FROM documents d WHERE lang <> 'de'
    AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
)
def matches_without_metadata(read):
    matches = read("documents").select(
        F.when(F.col("lang") != "de", F.col("doc_id")).alias("g_id"), F.col("source").alias("g_artist")
    )
    return queues.matches_without_metadata(matches, read("labels").select(F.col("doc_id").alias("id")))


@query(
    "Q4",
    """SELECT o_orderkey AS id, nullif(CASE WHEN o_orderstatus = 'F' THEN 'complete' ELSE o_orderstatus END, 'P')
    AS lyrics_state FROM orders WHERE o_orderstatus IN ('O', 'P')""",
)
def songs_incomplete(read):
    state = F.when(F.col("o_orderstatus") == "F", "complete").otherwise(F.col("o_orderstatus"))
    songs = read("orders").select(
        F.col("o_orderkey").alias("id"), F.nullif(state, F.lit("P")).alias("lyrics_state")
    )
    return queues.songs_incomplete(songs)


@query(
    "Q5",
    """SELECT c_custkey AS id, c_name AS name FROM customer c WHERE NOT EXISTS
    (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o_orderstatus = 'F')""",
)
def songs_without_lyrics(read):
    songs = read("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    lyrics = read("orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("id"))
    return queues.songs_without_lyrics(songs, lyrics)


@query(
    "Q6",
    """SELECT p_partkey AS id, p_name AS lyrics FROM part p WHERE p_type <> 'PROMO' AND NOT EXISTS
    (SELECT 1 FROM lineitem l WHERE l.l_partkey = p.p_partkey AND l_linenumber = 1 AND l_returnflag = 'R')""",
)
def lyrics_without_embedding(read):
    lyrics = read("part").select(
        F.col("p_partkey").alias("id"), F.when(F.col("p_type") != "PROMO", F.col("p_name")).alias("lyrics")
    )
    done = read("lineitem").where("l_linenumber = 1 AND l_returnflag = 'R'")
    return queues.lyrics_without(lyrics, done.select(F.col("l_partkey").alias("id")))


@query(
    "Q7",
    """SELECT doc_id AS id, md5(text) AS digest FROM documents d WHERE NOT EXISTS
    (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
)
def lyrics_without_traits(read):
    lyrics = read("documents").select(F.col("doc_id").alias("id"), F.col("text").alias("lyrics"))
    queue = queues.lyrics_without(lyrics, read("labels").select(F.col("doc_id").alias("id")))
    return queue.select("id", F.md5("lyrics").alias("digest"))


@query(
    "Q8",
    """SELECT vec_id AS id, len(embedding) AS dim FROM embeddings e WHERE NOT EXISTS
    (SELECT 1 FROM labels l WHERE l.doc_id = e.vec_id)""",
)
def embeddings_without_cluster(read):
    vectors = read("embeddings").select(F.col("vec_id").alias("id"), "embedding")
    queue = queues.embeddings_without_cluster(vectors, read("labels").select(F.col("doc_id").alias("id")))
    return queue.select("id", F.size("embedding").cast("long").alias("dim"))


LATEST_SQL = """latest AS (SELECT o_custkey AS id, o_totalprice AS balance FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rk
  FROM orders WHERE o_orderstatus = 'O') WHERE rk = 1)"""


def latest_orders(read):
    return read("orders").where("o_orderstatus = 'O'").select(
        F.col("o_custkey").alias("id"), F.col("o_totalprice").alias("balance"), "o_orderdate", "o_orderkey"
    )


def newest():
    return [F.desc("o_orderdate"), F.desc("o_orderkey")]


@query(
    "K4 J8",
    f"""WITH {LATEST_SQL}
    SELECT c_custkey AS id, c_acctbal AS balance FROM customer c WHERE c_acctbal > 0
    AND NOT EXISTS (SELECT 1 FROM latest l WHERE l.id = c.c_custkey)
    UNION ALL SELECT id, balance FROM latest""",
)
def balances_merged(read):
    target = read("customer").where("c_acctbal > 0").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance")
    )
    return upsert(target, latest_orders(read), ["id"], newest()).select("id", "balance")


def price_merge(read, only_if_changed):
    """Stored prices (some unknown, large parts missing) against a new price list."""
    part = read("part")
    price = F.col("p_retailprice")
    target = part.where("p_size <= 40").select(
        F.col("p_partkey").alias("id"), F.when(F.col("p_type") != "LARGE", price).alias("price")
    )
    incoming = part.select(
        F.col("p_partkey").alias("id"),
        F.when(F.col("p_type") == "ECONOMY", price).otherwise(price + 1).alias("price"),
    )
    return merge_with_actions(target, incoming, "id", "price", only_if_changed=only_if_changed)


def price_sql(changed: str) -> str:
    return f"""target AS (SELECT p_partkey AS id, CASE WHEN p_type <> 'LARGE' THEN p_retailprice END AS price
      FROM part WHERE p_size <= 40),
    incoming AS (SELECT p_partkey AS id,
      CASE WHEN p_type = 'ECONOMY' THEN p_retailprice ELSE p_retailprice + 1 END AS price FROM part),
    merged AS (SELECT coalesce(t.id, i.id) AS id,
      CASE WHEN t.id IS NULL THEN 'INSERT' WHEN i.id IS NOT NULL AND {changed} THEN 'UPDATE' ELSE 'KEEP' END
        AS merge_action, t.price AS old, i.price AS new
      FROM target t FULL OUTER JOIN incoming i ON t.id = i.id)"""


PRICES = "SELECT id, CASE merge_action WHEN 'KEEP' THEN old ELSE new END AS price, merge_action FROM merged"


@query("K6 J8", f"WITH {price_sql('t.price <> i.price')} {PRICES}")
def prices_merged_if_changed(read):
    return price_merge(read, True)


@query("K7 K8 J8", f"WITH {price_sql('TRUE')} {PRICES}")
def prices_merged_always(read):
    return price_merge(read, False)


@query(
    "A2",
    f"""WITH {price_sql('t.price <> i.price')}
    SELECT merge_action, count(*) AS rows FROM merged WHERE merge_action <> 'KEEP' GROUP BY 1""",
)
def merge_action_sizes(read):
    return action_counts(price_merge(read, True))


@query(
    "R1 R2 D2",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber,
      l_partkey, l_suppkey) AS rk FROM lineitem) WHERE rk = 1""",
)
def dearest_line_per_order(read):
    lines = read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    order = [F.desc("l_extendedprice"), "l_linenumber", "l_partkey", "l_suppkey"]
    return first_per_key(lines, ["l_orderkey"], order)


@query("D1", "SELECT DISTINCT md5(text) AS digest, length(text) AS chars FROM documents")
def distinct_texts(read):
    texts = read("documents").select("text").distinct()
    return texts.select(F.md5("text").alias("digest"), F.length("text").cast("long").alias("chars"))


@query("J5", "SELECT p_name, count(*) AS rows FROM part GROUP BY 1 HAVING count(*) > 1")
def duplicated_part_names(read):
    return duplicate_keys(read("part"), ["p_name"])


@query(
    "F18 F19 A3 A4",
    """SELECT count(*) AS rows, count(*) FILTER (lang = 'de') AS null_contents FROM documents""",
)
def scoring_input_profile(read):
    content = F.when(F.col("lang") != "de", F.col("text")).alias("content")
    return input_profile(read("documents").select("doc_id", content))
