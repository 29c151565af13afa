"""String similarity: indel distance and the weighted ratio (0 to 100) built on it.

Spark's `levenshtein` counts a substitution as one edit; the ratios here count it as two, so
they need the longest common subsequence. The scoring runs in Arrow batches on rows that a
join or a grouping has already brought together.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _places(text: str) -> dict[str, int]:
    """Bit set of the positions of every character."""
    places: dict[str, int] = {}
    for position, char in enumerate(text):
        places[char] = places.get(char, 0) | (1 << position)
    return places


def _common(places: dict[str, int], length: int, other: str) -> int:
    full = (1 << length) - 1
    row = full
    for char in other:
        hits = row & places.get(char, 0)
        row = ((row + hits) | (row - hits)) & full
    return length - row.bit_count()


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, one machine-wide row per character of `b`."""
    return len(a) if a == b else _common(_places(a), len(a), b)


def distance(a: str, b: str) -> int:
    """Insertions plus deletions that turn `a` into `b`."""
    return len(a) + len(b) - 2 * common_length(a, b)


def _share(edits: int, total: int) -> float:
    return (1 - edits / total) * 100 if total else 100.0


def ratio(a: str, b: str) -> float:
    return _share(distance(a, b), len(a) + len(b))


def _best_stretch(short: str, long: str) -> float:
    """Best ratio of `short` against the stretches of `long` of its length or cut at an edge.

    Moving a stretch by one changes its common length by one at most, so stretches that cannot
    reach the best one so far are passed over.
    """
    width, places = len(short), _places(short)
    last = len(long) - width
    most, start, at_edge = 0, 0, {}
    while start <= last:
        common = _common(places, width, long[start : start + width])
        at_edge[start] = common
        most = max(most, common)
        start += most - common + 1
    best = _share(2 * (width - most), 2 * width)
    first = at_edge[0]
    for size in range(width - 1, 0, -1):
        if _share(size + width - 2 * min(size, first), size + width) > best:
            common = _common(places, width, long[:size])
            best = max(best, _share(size + width - 2 * common, size + width))
        if _share(width - size, size + width) > best:
            common = _common(places, width, long[-size:])
            best = max(best, _share(size + width - 2 * common, size + width))
    return best


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter text against any same-length (or edge) stretch of the longer."""
    if not a or not b:
        return 100.0 if a == b else 0.0
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if short in long:
        return 100.0
    best = _best_stretch(short, long)
    return max(best, _best_stretch(long, short)) if len(a) == len(b) else best


def _words(words) -> str:
    return " ".join(sorted(words))


def token_ratio(a: str, b: str) -> float:
    """Better of the sorted-words ratio and the shared-words ratio."""
    a_words, b_words = a.split(), b.split()
    by_order = ratio(_words(a_words), _words(b_words))
    shared = set(a_words) & set(b_words)
    a_rest, b_rest = set(a_words) - shared, set(b_words) - shared
    if shared and (not a_rest or not b_rest):
        return 100.0
    a_only, b_only = _words(a_rest), _words(b_rest)
    common = len(" ".join(shared))
    gap = 1 if common else 0
    a_len, b_len = common + gap + len(a_only), common + gap + len(b_only)
    scores = [by_order, _share(distance(a_only, b_only), a_len + b_len)]
    if common:
        scores.append(_share(gap + len(a_only), common + a_len))
        scores.append(_share(gap + len(b_only), common + b_len))
    return max(scores)


def partial_token_ratio(a: str, b: str) -> float:
    """Partial ratio over sorted words; one shared word is a full match."""
    a_words, b_words = a.split(), b.split()
    if set(a_words) & set(b_words):
        return 100.0
    whole = partial_ratio(_words(a_words), _words(b_words))
    if len(set(a_words)) == len(a_words) and len(set(b_words)) == len(b_words):
        return whole
    return max(whole, partial_ratio(_words(set(a_words)), _words(set(b_words))))


def weighted_ratio(a: str, b: str) -> float:
    """Plain ratio, or a scaled token or partial ratio when that is larger."""
    if not a or not b:
        return 0.0
    best = ratio(a, b)
    proportion = max(len(a), len(b)) / min(len(a), len(b))
    if proportion < 1.5:
        return max(best, token_ratio(a, b) * 0.95)
    scale = 0.9 if proportion <= 8 else 0.6
    if best < 100 * scale:
        best = max(best, partial_ratio(a, b) * scale)
    if best < 95 * scale:
        best = max(best, partial_token_ratio(a, b) * 0.95 * scale)
    return best


@F.arrow_udf(T.IntegerType())
def indel_distance(a: pa.Array, b: pa.Array) -> pa.Array:
    pairs = zip(a.to_pylist(), b.to_pylist())
    return pa.array([None if x is None or y is None else distance(x, y) for x, y in pairs], pa.int32())


@F.arrow_udf(T.DoubleType())
def weighted_similarity(a: pa.Array, b: pa.Array) -> pa.Array:
    """Weighted ratio of two match texts; null when either is null."""
    pairs = zip(a.to_pylist(), b.to_pylist())
    return pa.array(
        [None if x is None or y is None else weighted_ratio(x, y) for x, y in pairs], pa.float64()
    )
