"""Title cleaning, search text, match text and embedding prompts as column expressions."""

from __future__ import annotations

from unicodedata import normalize

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The embedding task names the request format accepts.
EMBEDDING_TASKS = (
    "search result",
    "question answering",
    "fact checking",
    "code retrieval",
    "classification",
    "clustering",
    "sentence similarity",
)

# Title terms that mark live takes, remixes and translations.
EXCLUDED_TITLE_TERMS = (
    "(live)",
    "(remix)",
    "tradução",
    "traduções",
    "traduccion",
    "traducción",
    "traducciones",
    "traducciónes",
    "traduction",
    "traductions",
    "traduzione",
    "traduzioni",
    "vertaling",
    "vertalingen",
    "Übersetzung",
    "Ubersetzung",
    "Übersetzungen",
    "Ubersetzungen",
    "перевод",
    "переводы",
    "переклад",
    "переклади",
    "çeviri",
    "çeviriler",
    "अनुवाद",
    "翻译",
    "翻訳",
)


@F.arrow_udf(T.StringType())
def _compose(texts: pa.Array) -> pa.Array:
    composed = (t if t is None else normalize("NFC", t) for t in texts.to_pylist())
    return pa.array(composed, pa.string())


def nfc(text: Column) -> Column:
    """Unicode NFC. Only texts beyond ASCII travel to Python; the rest is already composed."""
    beyond_ascii = F.when(text.rlike(r"[^\x00-\x7F]"), text)
    return F.coalesce(_compose(beyond_ascii), text)


def drop_first(text: Column, pattern: str) -> Column:
    """Delete only the first match of `pattern`; `.` stops at newline characters alone.

    The match takes the rest of the text with it and gives it back, so there is no second one.
    """
    return F.regexp_replace(text, "(?d)" + pattern + r"([\s\S]*)\z", "$1")


def normalize_title(title: Column) -> Column:
    """NFC, then drop bracketed tags, featured artists and dashed tails; blanks collapse, no trim."""
    text = nfc(title)
    text = drop_first(text, r"\(.*\)")
    text = drop_first(text, r"\[.*\]")
    text = drop_first(text, r"(?i:feat)\.? .+\z")
    text = drop_first(text, r" - .*\z")
    return F.regexp_replace(text, r"(?U)\s+", " ")


def search_text(title: Column, artist: Column) -> Column:
    """`title artist`; null when either part is null."""
    return F.concat(title, F.lit(" "), artist)


def match_text(text: Column) -> Column:
    """Comparison form of a text: non-word characters to blanks, trimmed, lower case.

    Word characters are letters, numbers and the underscore; combining marks are not.
    """
    return F.lower(F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}_]", " ")))


def has_excluded_term(title: Column) -> Column:
    """Whether a title carries one of the live/remix/translation terms, ignoring case."""
    lowered = F.lower(title)
    hit = F.lit(False)
    for term in EXCLUDED_TITLE_TERMS:
        hit = hit | lowered.contains(term.lower())
    return hit


def build_prompt(content: Column, title: Column | None = None, task: str | None = None) -> Column:
    """Embedding prompt: task form when `task` is set, title form otherwise; bars are removed."""
    if task is not None and task not in EMBEDDING_TASKS:
        raise ValueError(f"{task!r} is not an embedding task")
    bar, nothing = F.lit("|"), F.lit("")
    content = F.replace(content, bar, nothing)
    if task is not None:
        return F.concat(F.lit(f"task: {task} | query: "), content)
    title = F.lit("none") if title is None else F.replace(title, bar, nothing)
    return F.concat(F.lit("title: "), title, F.lit(" | text: "), content)
