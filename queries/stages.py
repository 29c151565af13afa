"""Whole stages against stored tables: a database per run, filled from the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playledger import schemas
from playledger.operators.normalize import normalize
from playledger.operators.responses import TRIMMED_SONG_FIELDS
from playledger.plans import library, listening, quality, vectors
from playledger.plans.tables import Tables
from playledger.session import ensure_checkpoint_dir
from playledger.sinks.publish import publish
from playledger.sinks.tables import append, load_embeddings, merge, merge_nested, replace, staged
from playledger.sources.records import read_embedding_results, read_job_results
from playledger.sources.tables import read_parquet_files, read_table
from queries.nested import HITS_SQL, search_responses
from queries.plays import HISTORY, RAW_SQL, raw_plays, shown
from queries.registry import query
from queries.vectors import DIM, GROUPS, NEAREST_SQL, counted, embeddings, label_means, letter_counts


class Stored:
    """A database and a folder of the shared storage for one run of stages."""

    def __init__(self, read):
        self.spark = read.spark
        self.name = f"run_{uuid.uuid4().hex}"
        self.spark.sql(f"CREATE DATABASE {self.name}")
        self.tables = Tables(listening=self.name, library=self.name)
        self.folder = f"{ensure_checkpoint_dir(self.spark)}/{self.name}"

    def lines(self, records: DataFrame, kind: str) -> str:
        """The folder in which `records` are, one JSON document per line."""
        path = f"{self.folder}/{kind}"
        records.select(F.to_json(F.struct(*records.columns)).alias("value")).write.text(path)
        return path

    def put(self, df: DataFrame, table: str) -> None:
        df.write.saveAsTable(table)

    def result(self, df: DataFrame) -> DataFrame:
        """`df`, computed before the database goes."""
        found, _ = staged(df)
        self.spark.sql(f"DROP DATABASE {self.name} CASCADE")
        return found


WEEKS = ("2024-01-07", "2024-01-14")


@query(
    "S6 F1 F2 F3 T1 T2 K4 K13",
    f"""WITH {RAW_SQL},
    ranked AS (SELECT *, row_number() OVER (PARTITION BY url, played ORDER BY song, artist, album) AS rk FROM plays
      WHERE played >= epoch(TIMESTAMP '2024-01-07') AND played < epoch(TIMESTAMP '2024-01-21'))
    SELECT song, artist, album, artist__mbid, album__mbid, url, played, song AS mbid, '0' AS loved, 'small' AS image_size,
      url || '.png' AS image_text, '{{"userplaycount":"' || length(song) || '","tags":{{"tag":["' || album || '"]}}}}' AS other_fields
    FROM ranked WHERE rk = 1""",
)
def stored_plays(read):
    """Two weeks of play pages loaded by week, the first one twice; no field of a record is lost."""
    run = Stored(read)
    track = raw_plays(read).select(
        "name", "streamable", "url", "artist", "album", "date", "`@attr`",
        F.col("name").alias("mbid"), F.lit("0").alias("loved"),
        F.array(F.struct(F.lit("small").alias("size"), F.concat("url", F.lit(".png")).alias("#text"))).alias("image"),
        F.length("name").cast("string").alias("userplaycount"),
        F.struct(F.array("album.`#text`").alias("tag")).alias("tags"),
    )
    one = F.struct(*(F.col(f"`{name}`") for name in track.columns))
    pages = run.lines(track.select(F.struct(F.array(one).alias("track")).alias("recenttracks")), "pages")
    for week in (WEEKS[0], *WEEKS):
        listening.load_plays(run.spark, run.tables, pages, week)
    image = F.col("image")[0]
    whole = read_table(run.spark, run.tables.scrobbles).select(
        *HISTORY, "mbid", "loved", image["size"].alias("image_size"), image["text"].alias("image_text"), "other_fields"
    )
    return run.result(shown(whole))


@query(
    "Q1 S1 S9 K1 K2 F11 F12 F23",
    f"""WITH {HITS_SQL} SELECT song, CAST(artist AS VARCHAR) AS artist, g_id, g_title, g_primary_artist_names,
      CAST(d AS VARCHAR) AS g_release_date, CAST(g_pageviews AS BIGINT) AS g_pageviews, g_lyrics_complete,
      CAST(n - 1 AS INTEGER) AS hit_pos FROM hits
    UNION ALL SELECT p_name, CAST(p_partkey AS VARCHAR), NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM part WHERE p_type = 'SMALL'""",
)
def stored_searches(read):
    """Parts as plays, searched and recorded; searched again, nothing is left to ask."""
    run = Stored(read)
    asked = search_responses(read).withColumn("artist", F.col("artist").cast("string"))
    run.put(asked.select("song", "artist"), run.tables.scrobbles)
    answers = listening.with_search_text(asked).select("searchtext", F.from_json("body", schemas.SEARCH_HITS).alias("hits"))
    for _ in range(2):
        listening.record_searches(run.spark, run.tables, answers)
    return run.result(
        run.spark.table(run.tables.searches).select(
            "song", "artist", "g_id", "g_title", "g_primary_artist_names",
            F.col("g_release_date").cast("string").alias("g_release_date"), "g_pageviews", "g_lyrics_complete", "hit_pos",
        )
    )


def song_answers(read, title: str):
    """A customer as a song's JSON body: declared fields, all fields that are not stored, and unknown ones."""
    person = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit(True).alias("is_verified"))
    guests = F.transform(
        F.sequence(F.lit(0), F.col("c_custkey") % 3),
        lambda k: F.struct((F.col("c_custkey") * 10 + k).alias("id"), F.concat(F.lit("guest "), k.cast("string")).alias("name")),
    )
    body = F.struct(
        F.col("c_custkey").alias("id"),
        F.concat(F.lit(title), "c_name").alias("title"),
        F.when(F.col("c_nationkey") % 2 == 0, "complete").otherwise("unreleased").alias("lyrics_state"),
        F.struct(F.col("c_nationkey").alias("id"), F.col("c_mktsegment").alias("name"), person.alias("artist")).alias("album"),
        F.struct(F.lit("plain text").alias("plain")).alias("description"),
        F.slice(guests, F.lit(1), F.col("c_custkey") % 3).alias("featured_artists"),
        F.array(F.struct(F.lit("Mix").alias("label"), F.array(person).alias("artists"))).alias("custom_performances"),
        *(F.struct(F.lit(1).alias("x"), F.array(F.lit(2)).alias("y")).alias(name) for name in TRIMMED_SONG_FIELDS),
        F.struct(F.array("c_nationkey").alias("in"), F.col("c_mktsegment").alias("of")).alias("charts"),
        F.col("c_nationkey").cast("string").alias("hype"),
    )
    status = F.when(F.col("c_mktsegment") == "BUILDING", 404).otherwise(200)
    # Dealt out first: a body is a hundred times as large as the stored row it is made of.
    return read("customer").repartition("c_custkey").select(
        F.col("c_custkey").alias("id"), F.col("c_custkey").alias("seq"), status.alias("status"), F.to_json(body).alias("body")
    )


SONGS_SQL = """songs AS (SELECT c_custkey AS id, c_name AS title,
      CASE WHEN c_nationkey % 2 = 0 THEN 'complete' ELSE 'unreleased' END AS lyrics_state, CAST(c_nationkey AS BIGINT) AS album__id,
      c_mktsegment AS album__name, c_name AS album__artist__name, 'plain text' AS description__plain,
      '{"charts":{"in":[' || c_nationkey || '],"of":"' || c_mktsegment || '"},"hype":"' || c_nationkey || '"}' AS other_fields
    FROM customer WHERE c_acctbal >= 0 AND c_mktsegment <> 'BUILDING')"""
SONG_COLUMNS = ("id", "title", "lyrics_state", "album__id", "album__name", "album__artist__name", "description__plain", "other_fields")


def loaded_songs(read):
    run = Stored(read)
    matches = read("customer").where("c_acctbal >= 0").select(F.col("c_name").alias("song"), F.lit("x").alias("artist"), F.col("c_custkey").alias("g_id"))
    run.put(matches, run.tables.matches)
    for _ in range(2):
        library.load_songs(run.spark, run.tables, song_answers(read, ""))
    return run


@query(
    "Q3 S9 F13 F21 K12 K4",
    f"""WITH {SONGS_SQL}, guests AS (SELECT id AS of, unnest(range(0, id % 3)) AS k FROM songs)
    SELECT songs.*, CAST(k AS BIGINT) AS guest_idx, id * 10 + k AS guest_id, 'guest ' || k AS guest, title AS performer
    FROM songs LEFT JOIN guests ON of = id""",
)
def stored_songs(read):
    """Songs of the matches with their nested artists; trimmed fields are gone, unknown ones are kept."""
    run = loaded_songs(read)
    songs = run.spark.table(run.tables.songs)
    if set(TRIMMED_SONG_FIELDS) & {name.split("__")[0] for name in songs.columns}:
        raise AssertionError("a trimmed field is stored")
    guests = run.spark.table(f"{run.tables.songs}__featured_artists").select(
        F.col("_dlt_root_id").alias("of"), F.col("_dlt_list_idx").alias("guest_idx"), F.col("id").alias("guest_id"), F.col("name").alias("guest")
    )
    performers = run.spark.table(f"{run.tables.songs}__custom_performances__artists").select(
        F.col("_dlt_root_id").alias("by"), F.col("name").alias("performer")
    )
    both = songs.join(guests, F.col("_dlt_id") == F.col("of"), "left").join(performers, F.col("_dlt_id") == F.col("by"), "left")
    return run.result(both.select(*SONG_COLUMNS, "guest_idx", "guest_id", "guest", "performer"))


@query(
    "Q4 K4",
    f"""WITH {SONGS_SQL} SELECT id, CASE lyrics_state WHEN 'complete' THEN '' ELSE 'again ' END || title AS title,
      CAST(id % 3 AS BIGINT) AS guests FROM songs""",
)
def stored_recheck(read):
    """Incomplete songs are asked for again and replaced with their child rows; complete ones stay."""
    run = loaded_songs(read)
    library.recheck_incomplete_songs(run.spark, run.tables, song_answers(read, "again "))
    guests = run.spark.table(f"{run.tables.songs}__featured_artists").groupBy(F.col("_dlt_root_id").alias("of")).agg(F.count(F.lit(1)).alias("n"))
    songs = run.spark.table(run.tables.songs).join(guests, F.col("_dlt_id") == F.col("of"), "left")
    return run.result(songs.select("id", "title", F.coalesce("n", F.lit(0)).cast("long").alias("guests")))


@query(
    "Q5 Q7 F10 F22 M5 S4",
    "SELECT doc_id AS id, text AS lyrics, "
    + ", ".join(f"CASE WHEN text <> '' THEN {counted(v, k).split(' AS ' + k)[0]} END AS {k}" for k, v in GROUPS.items())
    + " FROM (SELECT doc_id, NULLIF(text, '') AS text FROM documents WHERE text <> '' OR lang = 'en')",
)
def stored_lyrics(read):
    """Lyrics of the songs without any, then their scores; both stages twice."""
    run = Stored(read)
    docs = read("documents")
    state = F.when(F.col("lang") == "en", "complete").otherwise("unreleased")
    run.put(docs.select(F.col("doc_id").alias("id"), F.lit("t").alias("full_title"), state.alias("lyrics_state")), run.tables.songs)
    answers = docs.select(F.col("doc_id").alias("id"), F.col("doc_id").alias("seq"), F.lit(200).alias("status"), F.col("text").alias("lyrics"))
    for _ in range(2):
        library.load_lyrics(run.spark, run.tables, answers)
        library.score_lyrics(run.spark, run.tables, letter_counts)
    lyrics, traits = run.spark.table(run.tables.lyrics), run.spark.table(run.tables.traits)
    return run.result(lyrics.join(traits, "id", "left").select("id", "lyrics", *GROUPS))


@query(
    "S7 K5 F26 F27 F28",
    """WITH plays AS (SELECT *, o_orderkey % 7 AS album, o_custkey AS artist FROM orders WHERE o_totalprice > 1000),
    known AS (SELECT * FROM plays WHERE o_orderstatus <> 'F')
    SELECT 'track' AS kind, 't' || o_orderkey AS id, o_orderpriority AS name, 'a' || artist || '/b' || album AS parts,
      CAST(o_orderkey AS BIGINT) AS number, '{"chart":{"rank":' || o_orderkey || '}}' AS other_fields FROM known
    UNION ALL SELECT DISTINCT 'album', 'b' || album, 'album ' || album, 'album', CAST(album AS BIGINT), NULL FROM plays
    UNION ALL SELECT DISTINCT 'artist', 'a' || artist, 'artist ' || artist, 'u' || artist, NULL, NULL FROM plays""",
)
def stored_recents(read):
    """Recent plays as track, album and artist tables; a play without an id still names its album and artists."""
    run = Stored(read)
    artist, album = F.col("o_custkey").cast("string"), F.col("o_orderkey") % 7
    play = read("orders").where("o_totalprice > 1000").select(
        F.when(F.col("o_orderstatus") != "F", F.concat(F.lit("t"), "o_orderkey")).alias("id"),
        F.col("o_orderpriority").alias("name"),
        F.lit("2026-01-25T00:00:01Z").alias("played_at"),
        F.array(
            F.struct(F.concat(F.lit("a"), artist).alias("id"), F.concat(F.lit("artist "), artist).alias("name"), F.concat(F.lit("u"), artist).alias("uri")),
            F.struct(F.lit(None).cast("string").alias("id"), F.lit("local").alias("name"), F.lit("x").alias("uri")),
        ).alias("artists"),
        F.struct(
            F.concat(F.lit("b"), album.cast("string")).alias("id"), F.concat(F.lit("album "), album.cast("string")).alias("name"),
            F.lit("album").alias("album_type"), album.alias("total_tracks"), F.array(F.lit("DE")).alias("available_markets"),
        ).alias("album"),
        F.array(F.lit("DE")).alias("available_markets"),
        F.col("o_orderkey").alias("track_number"),
        F.struct(F.col("o_orderkey").alias("rank")).alias("chart"),
    )
    path = run.lines(play, "recents")
    for _ in range(2):
        listening.load_recents(run.spark, run.tables, path, after=0)
    tracks, albums, artists = (run.spark.table(run.tables.recent(kind)) for kind in ("tracks", "albums", "artists"))
    none = F.lit(None)
    both = F.concat_ws("/", "artist_id", "album_id")
    found = tracks.select(F.lit("track").alias("kind"), "id", "name", both.alias("parts"), F.col("track_number").alias("number"), "other_fields")
    found = found.unionByName(
        albums.select(F.lit("album").alias("kind"), "id", "name", F.col("album_type").alias("parts"), F.col("total_tracks").alias("number"), none.cast("string").alias("other_fields"))
    ).unionByName(
        artists.select(F.lit("artist").alias("kind"), "id", "name", F.col("uri").alias("parts"), none.cast("long").alias("number"), none.cast("string").alias("other_fields"))
    )
    return run.result(found)


@query(
    "M8 K3 F17 F20 M7 S3 S8 K6 K7 K8 K11",
    """SELECT vec_id AS id, CAST(unnest(range(0, 64)) AS INTEGER) AS at,
      unnest(CASE WHEN label % 2 = 0 THEN embedding::DOUBLE[] WHEN vec_id % 2 = 0 THEN list_transform(embedding, lambda x: -(x::DOUBLE)) END) AS value
    FROM embeddings WHERE label % 2 = 0 OR vec_id % 2 = 0""",
)
def stored_extraction(read):
    """Job states refreshed, results of succeeded jobs extracted over stored vectors; whole vectors are shown."""
    run = Stored(read)
    own = embeddings(read).join(read("embeddings").select(F.col("vec_id").alias("id"), "label"), "id")
    negated = F.transform("embedding", lambda x: -x)
    load_embeddings(own.where("id % 2 = 0").select("id", negated.alias("embedding")), run.tables.embeddings(), only_if_changed=True, unique_source=True)
    parity = (F.col("label") % 2).alias("label")
    labels = read("embeddings").select(F.concat(F.lit("job "), parity).alias("name"), parity).distinct()
    run.put(labels.select("name", F.lit("JOB_STATE_RUNNING").alias("state")), run.tables.jobs())
    states = labels.select("name", F.when(F.col("label") % 2 == 0, "JOB_STATE_SUCCEEDED").otherwise("JOB_STATE_FAILED").alias("state"))
    for _ in range(2):
        vectors.refresh_embedding_jobs(run.spark, run.tables, states)
    line = own.select("label", F.to_json(F.struct(F.col("id").cast("string").alias("key"), F.struct(F.struct(F.col("embedding").alias("values")).alias("embedding")).alias("response"))).alias("value"))
    path = f"{run.folder}/results"
    for done in (0, 1):
        line.where(F.col("label") % 2 == done).select("value").write.text(f"{path}/{done}")
    placed = read_embedding_results(run.spark, f"{path}/*").select("file_name", F.col("id").cast("long").alias("id"))
    files = placed.join(own.select("id", "label"), "id").select(F.concat(F.lit("job "), parity).alias("name"), "file_name", F.lit(True).alias("has_dest")).distinct()
    for kind in ("table", "table-changed"):
        vectors.extract_embeddings(run.spark, run.tables, f"{path}/*", files, format=kind)
    return run.result(run.spark.table(run.tables.embeddings()).select("id", F.posexplode("embedding").alias("at", "value")))


@query(
    "M7 F17 F20 S8 K7 K13",
    """SELECT vec_id AS id, CAST(pos AS INTEGER) AS pos, value FROM (
      SELECT vec_id, unnest(embedding)::DOUBLE AS value, generate_subscripts(embedding, 1) - 1 AS pos
      FROM embeddings WHERE label % 3 <> 2)
    UNION ALL SELECT -1, 0, count(*) FROM embeddings WHERE label % 3 = 0
    UNION ALL SELECT -2, 0, count(*) FROM embeddings WHERE label % 3 = 1
    UNION ALL SELECT -3, 0, 0""",
)
def stored_extraction_once(read):
    """Each result file loaded once: whole vectors, and the rows loaded by three runs as ids -1 to -3.

    Two jobs end before the first and the second run, the third never does; its results are in place all the while.
    """
    run = Stored(read)
    third = (F.col("label") % 3).alias("third")
    labelled = read("embeddings").select(F.col("vec_id").alias("id"), third)
    line = embeddings(read).join(labelled, "id").select(
        F.to_json(F.struct(F.col("id").cast("string").alias("key"), F.struct(F.struct(F.col("embedding").alias("values")).alias("embedding")).alias("response"))).alias("value"),
        F.concat(F.lit("batches/"), F.col("third").cast("string")).alias("job"),
    )
    path = f"{run.folder}/results"
    line.write.partitionBy("job").text(path)
    files = read_job_results(run.spark, path).select(F.col("job").alias("name"), "file_name", F.lit(True).alias("has_dest")).distinct()
    counts = []
    for ended in (0, 1, 1):
        state = F.when(F.col("third") <= ended, "JOB_STATE_SUCCEEDED").otherwise("JOB_STATE_RUNNING")
        jobs = labelled.select("third").distinct().select(F.concat(F.lit("batches/"), F.col("third").cast("string")).alias("name"), state.alias("state"))
        replace(jobs, run.tables.jobs())
        loaded = vectors.extract_new_embeddings(run.spark, run.tables, path, files)
        counts.append((-1 - len(counts), 0, float(sum(loaded.values()))))
    stored = run.spark.table(run.tables.embeddings()).select("id", F.posexplode("embedding").alias("pos", "value"))
    return run.result(stored.unionByName(run.spark.createDataFrame(counts, "id long, pos int, value double")))


@query(
    "K6 K11 J8 A2 K13",
    """WITH parts AS (SELECT vec_id AS id, unnest(embedding)::DOUBLE AS value, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings)
    SELECT id, CAST(pos AS INTEGER) AS pos, CASE WHEN id % 3 = 0 THEN value ELSE -value END AS value
      FROM parts WHERE id % 2 = 0 OR id % 3 = 0
    UNION ALL SELECT -1, 0, count(*) FROM embeddings WHERE vec_id % 3 = 0 AND vec_id % 2 = 1
    UNION ALL SELECT -2, 0, count(*) FROM embeddings WHERE vec_id % 6 = 0""",
)
def stored_buckets(read):
    """Vectors merged into a table of key buckets, with the rows per action as ids -1 (inserted) and -2 (updated)."""
    run = Stored(read)
    own, name = embeddings(read), run.tables.embeddings()
    negated = F.transform("embedding", lambda x: -x)
    load_embeddings(own.where("id % 2 = 0").select("id", negated.alias("embedding")), name, only_if_changed=True, buckets=16)
    counts = load_embeddings(own.where("id % 3 = 0"), name, only_if_changed=True)
    told = [(-1, 0, float(counts.get("INSERT", 0))), (-2, 0, float(counts.get("UPDATE", 0)))]
    stored = run.spark.table(name).select("id", F.posexplode("embedding").alias("pos", "value"))
    return run.result(stored.unionByName(run.spark.createDataFrame(told, "id long, pos int, value double")))


@query(
    "M4 M3 K9 K10 S4 S5 Q8 F8 A1",
    f"""WITH {NEAREST_SQL} SELECT id, CASE WHEN id % 3 = 0 THEN 7 ELSE cluster END AS cluster FROM assigned
    UNION ALL SELECT -1, 7""",
)
def stored_clusters(read):
    """Vectors without a label get that of the nearest stored center; stored labels and centers stay."""
    run = Stored(read)
    run.put(embeddings(read), run.tables.embeddings("clustering"))
    replace(label_means(read), run.tables.centroids)
    labelled = embeddings(read).where("id % 3 = 0").select("id").unionByName(run.spark.range(-1, 0))
    run.put(labelled.select("id", F.lit(7).cast("long").alias("cluster")), run.tables.clusters)
    for _ in range(2):
        vectors.cluster_lyrics(run.spark, run.tables, dim=DIM)
    return run.result(run.spark.table(run.tables.clusters))


@query(
    "K3 K9 K10 M4 M3 S4 S5 Q8 F8",
    f"""WITH {NEAREST_SQL} SELECT id, CASE WHEN id % 3 = 0 THEN 7 ELSE cluster END AS cluster FROM assigned""",
)
def published_clusters(read):
    """As `stored_clusters`, with labels and centers as published versions: a first pair, the new labels beside its centers."""
    run = Stored(read)
    run.put(embeddings(read), run.tables.embeddings("clustering"))
    labelled = embeddings(read).where("id % 3 = 0").select("id", F.lit(7).cast("long").alias("cluster"))
    publish({run.tables.centroids: label_means(read), run.tables.clusters: labelled}, run.tables.clustering)
    for _ in range(2):
        vectors.cluster_lyrics(run.spark, run.tables, dim=DIM, published=True)
    return run.result(run.spark.table(run.tables.clusters))


@query(
    "C1 C2 C3 A3 S4",
    """SELECT 'embeddings_have_expected_dim' AS "check", 'lyrics_embed' AS "table", count(*) = 0 AS passed, count(*) AS bad_rows
      FROM embeddings WHERE label = 3
    UNION ALL SELECT 'embeddings_have_expected_dim', 'lyrics_embed_clustering', TRUE, 0
    UNION ALL SELECT 'cluster_labels_have_centroids', 'lyrics_clusters', count(*) = 0, count(*)
      FROM embeddings WHERE label NOT IN (SELECT r_regionkey FROM region)
    UNION ALL SELECT 'big5_traits_are_complete', 'lyrics_big5', TRUE, 0""",
)
def stored_checks(read):
    """The checks over stored tables, two of which do not exist yet."""
    run = Stored(read)
    short = F.when(F.col("label") == 3, F.slice("embedding", 1, DIM - 1)).otherwise(F.col("embedding"))
    own = read("embeddings")
    run.put(own.select(F.col("vec_id").alias("id"), short.cast("array<double>").alias("embedding")), run.tables.embeddings())
    run.put(own.select(F.col("vec_id").alias("id"), F.col("label").cast("long").alias("cluster")), run.tables.clusters)
    run.put(read("region").select(F.col("r_regionkey").cast("long").alias("cluster"), F.array(F.lit(0.0)).alias("centroid")), run.tables.centroids)
    report = quality.check_tables(run.spark, run.tables, dim=DIM)
    return run.result(report.withColumn("table", F.replace("table", F.lit(f"{run.name}."), F.lit(""))))


@query(
    "K12 K4 K13",
    """WITH told AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS idx,
      count(*) OVER (PARTITION BY conv_id) AS n FROM conversations)
    SELECT conv_id AS id, CAST(n AS BIGINT) AS n_turns, CAST(idx AS BIGINT) AS idx, role,
      CASE WHEN conv_id % 3 = 0 THEN md5(text || '!') ELSE md5(text) END AS digest
    FROM told WHERE NOT (conv_id % 3 = 0 AND idx = 0 AND n > 2)""",
)
def merged_conversations(read):
    """Conversations as nested records, stored; every third comes again, edited and without its first turn."""
    run = Stored(read)
    root = f"{run.name}.talks"
    turn = F.struct("turn", F.struct(F.col("role").alias("name")).alias("speaker"), F.col("text").alias("body"))
    talks = read("conversations").groupBy(F.col("conv_id").alias("id")).agg(F.array_sort(F.collect_list(turn)).alias("turns"), F.count(F.lit(1)).alias("n_turns"))
    edited = F.transform(
        F.when(F.col("n_turns") > 2, F.slice("turns", F.lit(2), F.greatest(F.lit(1), F.size("turns") - 1))).otherwise(F.col("turns")),
        lambda t: t.withField("body", F.concat(t["body"], F.lit("!"))),
    )
    merge_nested(normalize(talks, root, ["id"]), root, ["id"])
    again, _ = staged(talks.where("id % 3 = 0").withColumn("turns", edited))
    for _ in range(2):
        merge_nested(normalize(again, root, ["id"]), root, ["id"])
    turns = run.spark.table(f"{root}__turns").select(
        F.col("_dlt_root_id").alias("of"), F.col("_dlt_list_idx").alias("place"), F.col("speaker__name").alias("role"), F.md5("body").alias("digest")
    )
    roots = run.spark.table(root)
    # places of an edited conversation count from its second turn
    moved = F.when((F.col("id") % 3 == 0) & (F.col("n_turns") > 2), F.col("place") + 1).otherwise(F.col("place"))
    return run.result(roots.join(turns, F.col("_dlt_id") == F.col("of")).select("id", "n_turns", moved.alias("idx"), "role", "digest"))


@query(
    "S2 S3 K1 K3 K9 K4",
    """SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE o_totalprice + 1 END AS price,
      CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS priority FROM orders
    UNION ALL SELECT o_orderkey, o_totalprice, NULL FROM orders WHERE o_orderstatus = 'P'""",
)
def stored_writes(read):
    """Replaced, merged with a new column, and appended to; read back from parquet files."""
    run = Stored(read)
    table = f"{run.name}.prices"
    orders = read("orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"), "o_orderstatus", F.col("o_orderpriority").alias("priority"))
    replace(orders.select("id", F.lit(0.0).alias("price")), table)
    replace(orders.select("id", (F.col("price") + 1).alias("price")), table)
    merge(orders.where("o_orderstatus = 'F'").select("id", "price", "priority"), table, ["id"])
    append(orders.where("o_orderstatus = 'P'").select("id", "price"), table)
    files = run.spark.table(table).inputFiles()
    return run.result(read_parquet_files(run.spark, files).select("id", "price", "priority"))
