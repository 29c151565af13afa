"""Title cleaning, match text, prompts and request lines over whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from playledger.functions.text import (
    build_prompt,
    has_excluded_term,
    match_text,
    normalize_title,
    search_text,
)
from playledger.operators.embedding_jobs import request_lines, with_prompt
from queries.registry import query


def page_titles(read):
    return read("pages").select("page_id", "url", "html").select(
        "page_id",
        "url",
        F.regexp_extract("html", r"<title>([^<]*)</title>", 1).alias("title"),
        F.regexp_extract("html", r'<html lang="([^"]*)"', 1).alias("lang"),
    )


def tagged_parts(read):
    """Part names with the tails that listened titles carry."""
    name = F.col("p_name")
    kind = F.col("p_type")
    song = (
        F.when(kind == "STANDARD", F.concat(name, F.lit(" (Live)\nB-side (Mix)")))
        .when(kind == "ECONOMY", F.concat(name, F.lit(" [Bonus]  Track")))
        .when(kind == "MEDIUM", F.concat(name, F.lit(" FEAT. "), F.col("p_brand")))
        .when(kind == "PROMO", F.concat(name, F.lit(" - Remastered - "), F.col("p_brand")))
        .when(kind == "LARGE", F.concat(F.lit("Cafe\u0301\u00a0"), name, F.lit(" (Übersetzung)")))
        .otherwise(name)
    )
    return read("part").select("p_partkey", song.alias("song"), F.col("p_brand").alias("artist"))


TAGGED_SQL = r"""tagged AS (SELECT p_partkey, p_brand AS artist, CASE p_type
    WHEN 'STANDARD' THEN p_name || ' (Live)' || chr(10) || 'B-side (Mix)'
    WHEN 'ECONOMY' THEN p_name || ' [Bonus]  Track'
    WHEN 'MEDIUM' THEN p_name || ' FEAT. ' || p_brand
    WHEN 'PROMO' THEN p_name || ' - Remastered - ' || p_brand
    WHEN 'LARGE' THEN 'Cafe' || chr(769) || chr(160) || p_name || ' (Übersetzung)'
    ELSE p_name END AS song FROM part)"""

CLEAN_SQL = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    nfc_normalize({0}), '\(.*\)', ''), '\[.*\]', ''), '(?i)feat\.? .+$', ''), ' - .*$', ''),
    '[\s\x0b\x{{85}}\p{{Z}}]+', ' ', 'g')"""


@query("F4", f"WITH {TAGGED_SQL} SELECT p_partkey, {CLEAN_SQL.format('song')} AS title FROM tagged")
def cleaned_part_titles(read):
    return tagged_parts(read).select("p_partkey", normalize_title(F.col("song")).alias("title"))


@query(
    "F4",
    rf"""SELECT page_id, {CLEAN_SQL.format("regexp_extract(html, '<title>([^<]*)</title>', 1)")} AS title FROM pages""",
)
def cleaned_page_titles(read):
    return page_titles(read).select("page_id", normalize_title(F.col("title")).alias("title"))


@query(
    "F4",
    rf"""SELECT doc_id, md5({CLEAN_SQL.format('text')}) AS digest FROM documents""",
)
def cleaned_documents(read):
    documents = read("documents").select("doc_id", "text")
    return documents.select("doc_id", F.md5(normalize_title(F.col("text"))).alias("digest"))


@query(
    "F5",
    f"""WITH {TAGGED_SQL} SELECT p_partkey,
    {CLEAN_SQL.format('song')} || ' ' || nullif(artist, 'Brand#7') AS searchtext FROM tagged""",
)
def search_texts(read):
    artist = F.nullif(F.col("artist"), F.lit("Brand#7"))
    text = search_text(normalize_title(F.col("song")), artist)
    return tagged_parts(read).select("p_partkey", text.alias("searchtext"))


@query(
    "F6",
    r"""SELECT doc_id, md5(lower(trim(regexp_replace(text, '[^\p{L}\p{N}_]', ' ', 'g')))) AS digest
    FROM documents""",
)
def match_texts(read):
    documents = read("documents").select("doc_id", "text")
    return documents.select("doc_id", F.md5(match_text(F.col("text"))).alias("digest"))


@query(
    "F25",
    f"""WITH {TAGGED_SQL} SELECT p_partkey,
    contains(lower(song), '(live)') OR contains(lower(song), 'übersetzung') AS excluded FROM tagged""",
)
def excluded_titles(read):
    return tagged_parts(read).select("p_partkey", has_excluded_term(F.col("song")).alias("excluded"))


def texts(read):
    """Documents as id, content and title, some titles unknown."""
    title = F.when(F.col("lang") != "es", F.concat("source", F.lit("|"), "lang"))
    return read("documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("content"), title.alias("title")
    )


TITLED_SQL = """'title: ' || CASE WHEN lang <> 'es' THEN replace(source || '|' || lang, '|', '')
    ELSE 'none' END || ' | text: ' || replace(text, '|', '')"""


@query("F7 F9", f"SELECT doc_id AS id, md5({TITLED_SQL}) AS digest FROM documents")
def titled_prompts(read):
    return with_prompt(texts(read)).select("id", F.md5("prompt").alias("digest"))


@query(
    "F7",
    """SELECT doc_id AS id, md5('task: clustering | query: ' || replace(text, '|', '')) AS digest
    FROM documents""",
)
def task_prompts(read):
    prompt = build_prompt(F.col("content"), task="clustering")
    return texts(read).select("id", F.md5(prompt).alias("digest"))


@query("M6 F10", f"SELECT doc_id AS key, 768 AS dim, md5({TITLED_SQL}) AS digest FROM documents")
def embedding_request_lines(read):
    """Request lines, read back as JSON."""
    parsed = F.from_json(
        "value",
        "key bigint, request struct<output_dimensionality: int, "
        "content: struct<parts: array<struct<text: string>>>>",
    )
    lines = request_lines(texts(read)).select(parsed.alias("r"))
    return lines.select(
        F.col("r.key").alias("key"),
        F.col("r.request.output_dimensionality").alias("dim"),
        F.md5(F.col("r.request.content.parts")[0]["text"]).alias("digest"),
    )
