"""Matching of listened songs to a catalogue and to search hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playledger.functions.similarity import weighted_similarity
from playledger.functions.text import match_text, normalize_title, search_text
from playledger.operators.blocking import MAX_BLOCK, near_pairs
from playledger.operators.validate import require_unique
from playledger.session import ensure_checkpoint_dir

CATALOGUE_CUTOFF = 96
SEARCH_CUTOFF = 90
# Up to this length no unequal text rounds to a score of 100, so an equal text is the best.
_EQUAL_IS_BEST = 99


def with_search_text(songs: DataFrame) -> DataFrame:
    """Adds the cleaned title and artist as one text to (song, artist)."""
    text = search_text(normalize_title(F.col("song")), F.col("artist"))
    return songs.withColumn("searchtext", text)


def best_matches(
    queries: DataFrame,
    candidates: DataFrame,
    cutoff: int = CATALOGUE_CUTOFF,
    max_block: int = MAX_BLOCK,
) -> DataFrame:
    """Best candidate of every query text at `cutoff` (96 to 100) or better.

    `queries(query)`, `candidates(match_id, text, pos)` -> `query, match_id, sim`. At this
    cutoff the weighted ratio equals the plain ratio: its token part cannot pass 95 and its
    partial part cannot pass 90. The highest rounded score wins, then the lowest `pos`.

    Copies are folded before anything is compared, and a query with an equal candidate needs
    no comparison at all. Both folded sides are read several times below, so they are written
    once to the checkpoint folder. No side of a join is broadcast: texts would meet in the driver.
    """
    ensure_checkpoint_dir(queries.sparkSession)
    asked = (
        queries.select("query").distinct().withColumn("text", match_text(F.col("query")))
    ).where("text <> ''")
    asked = asked.checkpoint()
    texts = asked.select("text").distinct()
    offered = (
        candidates.select("match_id", "pos", match_text(F.col("text")).alias("text"))
        .where("text <> ''")
        .groupBy("text")
        .agg(F.min(F.struct("pos", "match_id")).alias("first"))
        .checkpoint()
    )
    equal = texts.join(offered.hint("merge"), "text").select("text", "first", F.lit(100).alias("score"))
    settled = equal.where(F.length("text") <= _EQUAL_IS_BEST).select("text")
    open_texts = texts.join(settled.hint("merge"), "text", "left_anti")
    near = near_pairs(open_texts, offered, cutoff, max_block).select(
        F.col("query").alias("text"), "first", "score"
    )
    best = (
        equal.unionByName(near)
        .groupBy("text")
        .agg(F.min(F.struct((-F.col("score")).alias("rank"), "first")).alias("best"))
    )
    return asked.join(best.hint("merge"), "text").select(
        "query",
        F.col("best.first.match_id").alias("match_id"),
        (-F.col("best.rank")).alias("sim"),
    )


def keep_unmatched(queries: DataFrame, matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """Adds the queries without a match as (first candidate, score 0)."""
    if queries.isEmpty() or candidates.isEmpty():
        raise ValueError("queries and candidates must not be empty")
    first = candidates.agg(F.min(F.struct("pos", "match_id")).alias("f")).select("f.match_id")
    every = queries.select("query").join(matches, "query", "left")
    return every.select(
        "query",
        F.coalesce(F.col("match_id"), first.scalar()).alias("match_id"),
        F.coalesce(F.col("sim"), F.lit(0)).alias("sim"),
    )


def match_to_catalogue(
    songs: DataFrame,
    catalogue: DataFrame,
    *,
    position: str = "id",
    cutoff: int = CATALOGUE_CUTOFF,
    validate: bool = True,
) -> DataFrame:
    """(song, artist) rows matched to catalogue rows (id, title, artist, searchtext).

    `position` orders equally good candidates. `validate` checks that catalogue ids are unique.
    """
    if validate:
        require_unique(catalogue, ["id"], "catalogue")
    asked = with_search_text(songs.select("song", "artist"))
    candidates = catalogue.select(
        F.col("id").alias("match_id"), F.col("searchtext").alias("text"), F.col(position).alias("pos")
    )
    found = best_matches(asked.select(F.col("searchtext").alias("query")), candidates, cutoff)
    titles = catalogue.select(
        F.col("id").alias("g_id"),
        F.col("title").alias("g_title"),
        F.col("artist").alias("g_artist"),
    )
    return (
        found.withColumnsRenamed({"query": "searchtext", "match_id": "g_id"})
        .join(asked.hint("merge"), "searchtext")
        .join(titles.hint("merge"), "g_id")
        .select("song", "artist", "g_id", "g_title", "g_artist", F.col("sim").alias("match_score"))
    )


def best_in_group(pairs: DataFrame, group: str, order: str) -> DataFrame:
    """Best hit of every group by weighted ratio, without a cutoff; the first wins ties.

    `pairs` has `group`, `query`, `candidate`, `match_id` and `order`; returns `group, query,
    match_id, sim` with the score cut to a whole number. Copies of a pair are folded before
    they are scored, so a group never has to fit into one task.
    """
    folded = pairs.groupBy(group, "query", "candidate", "match_id").agg(F.min(order).alias("_at"))
    scored = folded.withColumn("score", _pair_score(F.col("query"), F.col("candidate"))).where(
        "score IS NOT NULL"
    )
    best = scored.groupBy(group).agg(
        F.min(F.struct((-F.col("score")).alias("rank"), "_at", "query", "match_id")).alias("b")
    )
    return best.select(
        group,
        F.col("b.query").alias("query"),
        F.col("b.match_id").alias("match_id"),
        F.floor(-F.col("b.rank")).cast("int").alias("sim"),
    )


def _pair_score(query: Column, candidate: Column) -> Column:
    return weighted_similarity(match_text(query), match_text(candidate))


def match_search_results(
    searches: DataFrame, order: str, cutoff: int = SEARCH_CUTOFF, per_song: bool = False
) -> DataFrame:
    """One row per search text: its best hit, or song and artist alone below the cutoff.

    `order` gives the order of the hits. Songs that share a search text are answered once, as
    the first of them, unless `per_song` asks for an answer to each.
    """
    group = ["searchtext", "song", "artist"] if per_song else ["searchtext"]
    hits = searches.where("g_id IS NOT NULL AND searchtext IS NOT NULL").withColumn(
        "g_searchtext", search_text(F.col("g_title"), F.col("g_primary_artist_names"))
    )
    answer = F.struct(
        F.col(order).alias("_at"), "song", "artist", "g_title", "g_primary_artist_names"
    )
    # Fold copies of a hit before scoring; keep the first row of each.
    folded = hits.groupBy(*group, "g_id", "g_searchtext").agg(F.min(answer).alias("row"))
    scored = folded.withColumn("score", _pair_score(F.col("searchtext"), F.col("g_searchtext")))
    # The answer is the first row that carries the winning id, whatever text that row has.
    by_id = scored.groupBy(*group, "g_id").agg(
        F.min("row").alias("row"),
        F.min(
            F.when(
                F.col("score").isNotNull(),
                F.struct((-F.col("score")).alias("rank"), F.col("row._at").alias("at")),
            )
        ).alias("rank"),
    )
    best = by_id.groupBy(*group).agg(
        F.min("row").alias("first"),
        F.min(
            F.when(F.col("rank").isNotNull(), F.struct("rank", "g_id", "row"))
        ).alias("hit"),
    )
    sim = F.floor(-F.col("hit.rank.rank")).cast("int")
    matched = F.coalesce(sim >= cutoff, F.lit(False))
    picked = F.when(matched, F.col("hit.row")).otherwise(F.col("first"))
    return best.select(
        picked["song"].alias("song"),
        picked["artist"].alias("artist"),
        F.when(matched, F.col("hit.g_id")).alias("g_id"),
        F.when(matched, F.col("hit.row.g_title")).alias("g_title"),
        F.when(matched, F.col("hit.row.g_primary_artist_names")).alias("g_artist"),
        F.when(matched, sim).alias("match_score"),
    )
