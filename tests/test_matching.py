import random

import pytest

from playledger.functions import similarity as sim
from playledger.operators import matching
from playledger.operators.blocking import near_pairs
from tests.conftest import rows


def slow_common(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = (
                table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
            )
    return table[-1][-1]


def test_common_length_against_table():
    rng = random.Random(7)
    for _ in range(300):
        a = "".join(rng.choices("abcdé ", k=rng.randint(0, 90)))
        b = "".join(rng.choices("abcdé ", k=rng.randint(0, 90)))
        assert sim.common_length(a, b) == slow_common(a, b)


def test_partial_ratio_against_all_stretches():
    rng = random.Random(9)
    for _ in range(400):
        a = "".join(rng.choices("abc ", k=rng.randint(1, 12)))
        b = "".join(rng.choices("abc ", k=rng.randint(1, 30)))
        best = 0
        for short, long in ((a, b), (b, a)):
            if len(short) <= len(long):
                width = len(short)
                for end in range(1, len(long) + width):
                    best = max(best, sim.ratio(short, long[max(0, end - width) : end]))
        assert sim.partial_ratio(a, b) == pytest.approx(best)


@pytest.mark.parametrize(
    "score, a, b, expected",
    [
        (sim.ratio, "this is a test", "this is a test!", 96.55),
        (sim.partial_ratio, "this is a test", "this is a test!", 100),
        (sim.token_ratio, "fuzzy wuzzy was a bear", "wuzzy fuzzy was a bear", 100),
        (sim.token_ratio, "fuzzy was a bear", "fuzzy fuzzy was a bear", 100),
        (sim.weighted_ratio, "this is a test", "this is a new test", 95.0),
        (sim.weighted_ratio, "hello", "hello world", 90.0),
        (sim.weighted_ratio, "abc", "", 0.0),
        (sim.weighted_ratio, "hello world", "hello world", 100.0),
    ],
)
def test_scores(score, a, b, expected):
    assert score(a, b) == pytest.approx(expected, abs=0.01)


def brute_force(queries, candidates, cutoff):
    """Weighted ratio over all pairs: highest rounded score, then lowest position."""
    answers = {}
    for q in queries:
        best = None
        for pos, c in enumerate(candidates):
            score = int(sim.weighted_ratio(q, c) + 0.5)
            if score >= cutoff and (best is None or score > best[0]):
                best = (score, pos)
        if best:
            answers[q] = (best[1], best[0])
    return answers


def edited(rng, text, n):
    chars = list(text)
    for _ in range(n):
        at = rng.randrange(len(chars))
        if rng.random() < 0.5 and len(chars) > 2:
            del chars[at]
        else:
            chars.insert(at, rng.choice("abcdefgh"))
    return " ".join("".join(chars).split())


def crowd(rng, n):
    """Numbered titles by one artist: nearly every piece of a text is shared by all."""
    return [f"untitled recording {rng.randrange(10**6):06d} by artist" for _ in range(n)]


@pytest.mark.parametrize("max_block", [12, 50])
def test_best_matches_equals_brute_force(spark, max_block):
    rng = random.Random(11)
    words = ["love", "night", "blue", "river", "dance", "the", "a", "fire", "golden", "rain"]
    base = [" ".join(rng.choices(words, k=rng.randint(1, 14))) for _ in range(80)]
    base += crowd(rng, 60)
    candidates = base + [edited(rng, t, rng.randint(1, 4)) for t in base[::3]]
    rng.shuffle(candidates)
    queries = sorted(
        {edited(rng, t, rng.randint(0, 4)) for t in base} | set(base[::7])
    )
    expected = brute_force(queries, candidates, 96)
    asked = spark.createDataFrame([(q,) for q in queries], "query string")
    offered = spark.createDataFrame(
        [(i, c, i) for i, c in enumerate(candidates)], "match_id long, text string, pos long"
    )
    got = matching.best_matches(asked, offered, max_block=max_block)
    assert {r.query: (r.match_id, r.sim) for r in got.collect()} == expected
    assert len(expected) > 40


def test_long_texts_may_tie_with_an_equal_text(spark):
    """From 100 characters on, one edit can round to 100; the earlier candidate wins."""
    text = "abcdefghij" * 12
    asked = spark.createDataFrame([(text,)], "query string")
    offered = spark.createDataFrame(
        [(7, text + "x", 0), (8, text, 1)], "match_id long, text string, pos long"
    )
    assert rows(matching.best_matches(asked, offered)) == [(text, 7, 100)]


def test_near_pairs_rejects_low_cutoff(spark):
    empty = spark.createDataFrame([], "text string")
    with pytest.raises(ValueError):
        near_pairs(empty, empty, 80)


def _offered(spark, texts, ids):
    data = [(i, t, p) for p, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(data, "match_id long, text string, pos long")


def test_batch_match(spark):
    asked = spark.createDataFrame([("hello",), ("goodbye",)], "query string")
    offered = _offered(spark, ["hello world", "hello", "goodbye"], [0, 1, 2])
    found = matching.best_matches(asked, offered)
    assert rows(matching.keep_unmatched(asked, found, offered)) == [
        ("goodbye", 2, 100),
        ("hello", 1, 100),
    ]
    asked = spark.createDataFrame([("hello",), ("zzz",)], "query string")
    offered = _offered(spark, ["hello world", "hello"], [7, 8])
    found = matching.best_matches(asked, offered)
    assert rows(matching.keep_unmatched(asked, found, offered)) == [("hello", 8, 100), ("zzz", 7, 0)]
    with pytest.raises(ValueError):
        matching.keep_unmatched(asked.limit(0), found, offered)


def test_best_in_group(spark):
    pairs = spark.createDataFrame(
        [
            ("g", "hello world", "goodbye", 101, 0),
            ("g", "hello world", "hello world", 202, 1),
            ("g", "hello world", "Hello, World!", 303, 2),
            ("h", "abc", "xyz", 5, 0),
        ],
        "g string, query string, candidate string, match_id long, pos int",
    )
    assert rows(matching.best_in_group(pairs, "g", "pos")) == [
        ("g", "hello world", 202, 100),
        ("h", "abc", 5, 0),
    ]


def test_match_to_catalogue(spark):
    catalogue = spark.createDataFrame(
        [(1, "Hello", "World", "Hello World"), (2, "Other", "Band", "Other Band")],
        "id long, title string, artist string, searchtext string",
    )
    songs = spark.createDataFrame(
        [("Hello", "World"), ("Hello (Remix)", "World"), ("Intruder", "Fixture")],
        "song string, artist string",
    )
    assert rows(matching.match_to_catalogue(songs, catalogue)) == [
        ("Hello (Remix)", "World", 1, "Hello", "World", 96),
        ("Hello", "World", 1, "Hello", "World", 100),
    ]
    assert matching.match_to_catalogue(songs.limit(0), catalogue).isEmpty()
    with pytest.raises(ValueError):
        matching.match_to_catalogue(songs, catalogue.union(catalogue))


HITS = (
    "song string, artist string, searchtext string, g_id long, g_title string, "
    "g_primary_artist_names string, pos int"
)


def test_match_search_results(spark):
    hits = spark.createDataFrame(
        [
            ("Hello", "World", "Hello World", 1, "Hello", "World", 0),
            ("Hello", "World", "Hello World", 2, "Nothing", "Who", 1),
            ("Nope", "Band", "Nope Band", 2, "Nothing", "Who", 2),
            ("Null", "Hit", "Null Hit", None, None, None, 3),
        ],
        HITS,
    )
    assert rows(matching.match_search_results(hits, "pos")) == [
        ("Hello", "World", 1, "Hello", "World", 100),
        ("Nope", "Band", None, None, None, None),
    ]


def test_match_search_results_shared_text(spark):
    """The first row with the winning id answers; two songs with one text are answered once."""
    hits = spark.createDataFrame(
        [
            ("Hello", "World", "Hello World", 1, "Hello there", "World", 0),
            ("Hello (Live)", "World", "Hello World", 1, "Hello", "World", 1),
        ],
        HITS,
    )
    assert rows(matching.match_search_results(hits, "pos")) == [
        ("Hello", "World", 1, "Hello there", "World", 100)
    ]
    assert len(rows(matching.match_search_results(hits, "pos", per_song=True))) == 2


def test_search_results_equal_brute_force(spark):
    """Groups of hits against a loop over all of them, ties and repeated ids included."""
    rng = random.Random(3)
    words = ["love", "night", "blue", "river", "dance", "the", "a", "fire"]
    phrase = lambda low, high: " ".join(rng.choices(words, k=rng.randint(low, high)))
    data = []
    for group in range(60):
        song, artist = phrase(1, 4), phrase(1, 2)
        for _ in range(rng.randint(1, 6)):
            title = rng.choice([song, phrase(1, 4), edited(rng, song, 1), song + " " + phrase(1, 9)])
            data.append((song, artist, f"{song} {artist}", rng.randrange(6), title, artist, len(data)))
    groups = {}
    for row in data:
        groups.setdefault(row[2], []).append(row)
    expected = []
    for text, hits in groups.items():
        scores = [sim.weighted_ratio(text, f"{h[4]} {h[5]}") for h in hits]
        best = max(scores)
        winner = hits[scores.index(best)][3]
        if int(best) >= 90:
            row = next(h for h in hits if h[3] == winner)
            expected.append((row[0], row[1], winner, row[4], row[5], int(best)))
        else:
            expected.append((hits[0][0], hits[0][1], None, None, None, None))
    got = rows(matching.match_search_results(spark.createDataFrame(data, HITS), "pos"))
    assert got == sorted(expected, key=repr)
    assert 5 < sum(r[2] is not None for r in expected) < len(expected)


def test_crowded_blocks_stay_linear(spark):
    """Numbered titles share nearly every piece; far fewer pairs than all meet."""
    from playledger.operators import blocking

    rng = random.Random(5)
    side = lambda: spark.createDataFrame([(t,) for t in set(crowd(rng, 200))], "text string")
    queries, candidates = side(), side()
    met = []
    original = blocking._meet
    blocking._meet = lambda a, o, s: met.append(
        a.select("block").join(o.select("block"), "block")
    ) or original(a, o, s)
    try:
        found = near_pairs(queries, candidates, 96, 40).select("query", "candidate", "score").distinct()
    finally:
        blocking._meet = original
    texts = [[r[0] for r in side.collect()] for side in (queries, candidates)]
    scores = {(q, c): int(sim.ratio(q, c) + 0.5) for q in texts[0] for c in texts[1] if q != c}
    expected = {pair: score for pair, score in scores.items() if score >= 96}
    assert {(q, c): s for q, c, s in rows(found)} == expected and expected
    assert sum(pairs.count() for pairs in met) < len(texts[0]) * len(texts[1]) / 2
