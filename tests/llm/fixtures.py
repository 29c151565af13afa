"""Small tables with awkward rows, and plain-Python versions of what operators compute."""

import collections
import re

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bands string, leaf int, label string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def awkward_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing extra columns."""
    long = " ".join(f"wort{i % 977}" for i in range(30_000))
    rows = [
        (1, "the cat sat on the mat and it's fine.", "en", "a", 3, "x", 1, None),
        (1, "the cat sat on the mat and it's fine.", "en", "a", 3, "x", 1, None),
        (2, "The cat  sat on the mat\nand it's fine.", "en", None, None, None, None, "y"),
        (3, None, "fr", "b", 0, "x", 2, "y"),
        (4, "", "fr", "b", 0, "x", 2, "y"),
        (5, "   \n\t ", None, "b", 0, "x", 2, "y"),
        (6, long, "de", "c", 1, "x", 2, "y"),
        (7, long + " ende", "de", "c", 1, "x", 2, "y"),
        (8, "12 34 !?", "es", "c", 1, "x", 2, "y"),
        (9, "éàü ñandú über straße çà et là 中文   x", "es", "\U0001f600", 1, "x", 2, "y"),
        (None, "no number here but words enough for one", "en", None, 1, "x", 2, "y"),
        (-10, "<|endoftext|> inside, 'll of it <|startoftext|>", "en", "c", 1, "x", 2, "y"),
    ]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def shingle_counts(text):
    w = words(text)
    if not w:
        return collections.Counter()
    return collections.Counter([tuple(w[i : i + 5]) for i in range(len(w) - 4)] or [tuple(w)])


def probability_jaccard(a, b):
    union = set(a) | set(b)
    return sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in union) for i in set(a) & set(b))
