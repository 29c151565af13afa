"""Near-duplicates, mixing, language and class model against plain loops."""

import collections
import itertools
import math
import random
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from playledger.llm import brown, langid, mixing, prob_minhash
from playledger.llm.common import flat_texts
from playledger.llm.queries import held_out
from tests.llm.fixtures import LOWER, awkward_docs, empty_docs, probability_jaccard, shingle_counts, words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def given_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# near-duplicates


def shingled(*texts):
    data, edges = flat_texts(pa.array(texts))
    value, weight, owner = prob_minhash.shingles(data, edges)
    return value, weight, owner


def test_similarity_is_probability_jaccard():
    rng = random.Random(5)
    for _ in range(60):
        a, b = (" ".join(rng.choices("abcd", k=rng.randint(1, 50))) for _ in range(2))
        value, weight, owner = shingled(a, b)
        sides = [(value[owner == k], weight[owner == k], weight[owner == k].sum()) for k in range(2)]
        exact = probability_jaccard(shingle_counts(a), shingle_counts(b))
        assert prob_minhash.similarity(*sides) == pytest.approx(exact)
        for least in (0.01, exact - 1e-6, exact + 1e-6, 0.8):
            assert prob_minhash.alike(*sides, least) == (exact >= least)


def test_kept_shingle_sets_are_those_of_the_texts(monkeypatch):
    monkeypatch.setattr(prob_minhash, "KEPT_BYTES", 2000)
    rng, sets = random.Random(11), prob_minhash.ShingleSets()
    texts = [" ".join(rng.choices("abcdef", k=rng.randint(0, 40))) for _ in range(20)]
    for _ in range(30):
        picked = [rng.randrange(20) for _ in range(rng.randint(1, 6))]
        found = sets.of([bytes([k]) for k in picked], *flat_texts(pa.array([texts[k] for k in picked])))
        for k, (value, weight, total) in zip(picked, found):
            alone = shingled(texts[k])
            assert value.tolist() == alone[0].tolist() and weight.tolist() == alone[1].tolist() and total == weight.sum()


def test_signatures_estimate_it():
    rng = random.Random(6)
    text = [f"w{rng.randint(0, 200)}" for _ in range(500)]
    other = text[:]
    for k in range(0, 500, 60):
        other[k] = "changed"
    a, b = " ".join(text * 2), " ".join(other * 2)
    value, weight, owner = shingled(a, b)
    kept = prob_minhash.signatures(value, weight, owner, 2)
    exact = probability_jaccard(shingle_counts(a), shingle_counts(b))
    assert abs((kept[0] == kept[1]).mean() - exact) < 4 * math.sqrt(exact * (1 - exact) / prob_minhash.REGISTERS)


def brute_classes(rows):
    counts = [shingle_counts(r.text) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        small, large = sorted((sum(counts[i].values()), sum(counts[j].values())))
        if small and (words(rows[i].text) == words(rows[j].text) or small > 0.4 * large):
            if words(rows[i].text) == words(rows[j].text) or probability_jaccard(counts[i], counts[j]) >= 0.8:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    groups = collections.defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(rows[i].doc_id)
    return {(rows[i].doc_id, min((d for d in groups[root(i)] if d is not None), default=None), len(groups[root(i)])) for i in range(len(rows))}


def near_copies(spark):
    """A large family of near copies around one text, chains, exact copies, and texts apart."""
    rng = random.Random(7)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(120)]
    rows = []
    for _ in range(60):
        text = base[:]
        text[rng.randrange(120)] = f"x{rng.randint(0, 9)}"
        rows.append(" ".join(text))
    rows += [rows[3]] * 20 + [" ".join(base).upper()]
    chain = [f"c{k}" for k in range(200)]
    for k in range(6):
        rows.append(" ".join(chain[4 * k : 4 * k + 150]))
    rows += [" ".join(f"y{rng.randint(0, 10**6)}" for _ in range(60)) for _ in range(30)] + [None, "", "  ", "one", "ONE", "two words"]
    return spark.createDataFrame([(k * 3 % 128, t) for k, t in enumerate(rows)], "doc_id long, text string")


def test_classes_are_those_of_all_pairs(spark):
    docs = near_copies(spark)
    found = prob_minhash.near_duplicates(docs).collect()
    assert {tuple(r) for r in found} == brute_classes(docs.collect())
    assert len(found) == docs.count()


def test_class_edge_cases(spark):
    docs = awkward_docs(spark)
    found = sorted(map(tuple, prob_minhash.near_duplicates(docs).collect()), key=repr)
    wanted = {-10: (-10, 1), 1: (1, 3), 2: (1, 3), 3: (3, 1), 4: (4, 1), 5: (5, 1), 6: (6, 2), 7: (6, 2), 8: (8, 1), 9: (9, 1), None: (None, 1)}
    assert found == sorted([(r.doc_id, *wanted[r.doc_id]) for r in docs.collect()], key=repr)
    assert prob_minhash.near_duplicates(empty_docs(spark)).count() == 0


def test_all_pairs_of_a_crowd_without_likeness_are_compared(spark, monkeypatch):
    """Many members of one bucket that are not alike, but for one pair: it is found."""
    monkeypatch.setattr(prob_minhash, "FIRST_PIVOTS", 2)
    monkeypatch.setattr(prob_minhash, "MORE_PIVOTS", 2)
    texts = [(bytes([k]) * 16, f"a{k} b{k} c{k} d{k} e{k} f{k}") for k in range(1, 40)]
    texts.append((bytes([99]) * 16, texts[-1][1]))
    frame = spark.createDataFrame(texts, "node binary, text string")
    members = frame.select(F.lit(1).cast("long").alias("bucket"), "node", F.lit(40).cast("long").alias("size"), F.col("node").alias("label"))
    maps = prob_minhash.near_links(members, frame, 0.8)
    assert [(bytes(r.old)[0], bytes(r.new)[0]) for step in maps for r in step.collect()] in ([(99, 39)], [(39, 99)])


def test_a_family_around_the_limit_is_split_without_losing_a_link(spark, monkeypatch):
    """Copies of one text with few to many edits and cuts, shared edits, and a crowd nested in the crowd, in one bucket."""
    monkeypatch.setattr(prob_minhash, "FIRST_PIVOTS", 2)
    monkeypatch.setattr(prob_minhash, "MORE_PIVOTS", 2)
    monkeypatch.setattr(prob_minhash, "SALTED", 16)
    monkeypatch.setattr(prob_minhash, "HEADS", 3)
    monkeypatch.setattr(prob_minhash, "PART_BUCKETS", 2)
    rng = random.Random(5)
    base = [f"w{k}" for k in range(80)]
    other = base[:30] + [f"v{k}" for k in range(40)]
    texts = []
    for k in range(110):
        own = list(base if k < 80 else other)
        for _ in range(rng.choice([0, 1, 2, 2, 3, 3, 4])):
            at = rng.randrange(len(own))
            own[at] = f"x{at}" if rng.random() < 0.4 else f"y{k}"
        if rng.random() < 0.25:
            at = rng.randrange(60)
            del own[at : at + rng.choice([3, 8, 12])]
        texts.append((k.to_bytes(16, "big"), " ".join(own)))
    frame = spark.createDataFrame(texts, "node binary, text string")
    members = frame.select(F.lit(1).cast("long").alias("bucket"), "node", F.col("node").alias("label"))
    named = prob_minhash.relabelled(members, prob_minhash.near_links(members, frame, 0.8)).select("node", "label").collect()
    groups = collections.defaultdict(list)
    for row in named:
        groups[bytes(row.label)].append(int.from_bytes(row.node, "big"))
    docs = [Row(doc_id=k, text=text) for k, (_, text) in enumerate(texts)]
    assert {(d, min(g), len(g)) for g in groups.values() for d in g} == brute_classes(docs)
    assert 3 < len(groups) < 110


# mixing


def brute_targets(sizes, weights=(3, 1, 2), budget=1.5):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    full, total = set(), budget * sum(sizes.values())
    while True:
        free = [s for s in order if s not in full]
        rest = total - sum(2 * sizes[s] for s in full)
        target = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free} | {s: 2.0 * sizes[s] for s in full}
        over = {s for s in free if target[s] > 2 * sizes[s]}
        if not over:
            return target
        full |= over


def check_mix(docs):
    found = mixing.mixed_sizes(docs).toPandas()
    rows = docs.select("doc_id", "source", "text").collect()
    none = "\0null"
    key = [(r.doc_id if r.doc_id is not None else none, r.source if r.source is not None else none) for r in rows]
    sizes = collections.Counter()
    for r in rows:
        sizes[r.source] += len(words(r.text))
    targets = brute_targets(sizes)
    got = [(d if d == d and d is not None else none, s if isinstance(s, str) else none) for d, s in zip(found["doc_id"], found["source"])]
    assert collections.Counter(got) == collections.Counter(key)
    for source, part in found.groupby("source", dropna=False):
        source = source if isinstance(source, str) else None
        assert (part["source_size"] == sizes[source]).all()
        assert part["target"].to_numpy() == pytest.approx(targets[source])
        assert abs(part["taken"].sum() - targets[source]) <= part["size"].max()
    assert (found["taken"] <= 2 * found["size"]).all() and (found["taken"] % found["size"].clip(lower=1) == 0).all()
    return found


def test_mixture_meets_its_targets(given_docs, monkeypatch):
    monkeypatch.setattr(mixing, "LEAF_ROWS", 20)
    found = check_mix(given_docs)
    again = mixing.mixed_sizes(given_docs.repartition(7)).toPandas()
    assert found.sort_values("doc_id")["taken"].tolist() == again.sort_values("doc_id")["taken"].tolist()


def test_mixture_edge_cases(spark):
    check_mix(awkward_docs(spark))
    assert mixing.mixed_sizes(empty_docs(spark)).count() == 0
    assert mixing.take_mixture(empty_docs(spark)).columns == empty_docs(spark).columns


def test_taking_the_mixture_repeats_documents(spark):
    docs = awkward_docs(spark)
    taken = mixing.take_mixture(docs)
    assert taken.columns == docs.columns
    copies = mixing.mixed_sizes(docs).groupBy("doc_id").agg(F.sum("copies").alias("n"))
    wanted = {r.doc_id: r.n for r in copies.collect() if r.n}
    assert {r.doc_id: r["count"] for r in taken.groupBy("doc_id").count().collect()} == wanted


def test_pivot_keeps_sums_and_expectations():
    rng = np.random.default_rng(8)
    mean, n = np.zeros(40), 1500
    part = rng.random(40)
    for turn in range(n):
        frame = pd.DataFrame({"source": "a", "doc_id": np.arange(40), "seed": rng.integers(0, 2**62, 40), "size": np.arange(40), "whole": 0, "part": part, "leaf": 0})
        out = mixing.pivot(frame, 0).sort_values("doc_id")
        assert (out["part"] > 0).sum() <= 1
        assert (out["whole"] + out["part"]).sum() == pytest.approx(part.sum())
        mean += (out["whole"] + out["part"]).to_numpy() / n
    assert np.abs(mean - part).max() < 0.07


# language


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs, ~held_out(3))
    found = langid.identify(docs.drop("lang"), model).join(docs.select("doc_id", "lang"), "doc_id").filter(held_out(3))
    row = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("right"), F.min("score").alias("low"), F.max("score").alias("high")).first()
    assert row.right > 0.97 and 0 <= row.low and row.high <= 1


def test_language_edge_cases(spark):
    docs = awkward_docs(spark)
    model = langid.fit(docs, F.lit(True))
    assert model.languages == ("de", "en", "es")  # no French text has a word
    found = langid.identify(docs.withColumn("score", F.lit("mine")), model)
    assert found.columns == [*docs.columns, "lang_pred", "score", "n_languages"]
    rows = {r.doc_id: r for r in found.collect()}
    assert [rows[k].lang_pred for k in (3, 4, 5, 8)] == ["und"] * 4
    assert all(rows[k].score == 0.0 for k in (3, 4, 5, 8))
    assert rows[6].lang_pred == "de" and rows[1].lang_pred == "en"
    nothing = langid.fit(empty_docs(spark), F.lit(True))
    assert {r.lang_pred for r in langid.identify(docs, nothing).collect()} == {"und"}
    assert langid.identify(empty_docs(spark), model).count() == 0


def test_mixture_of_two_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs, F.lit(True))
    half = {r.lang: r.text[:3000] for r in docs.filter("n_chars > 4000").orderBy("doc_id").collect()}
    texts = [(1, half["en"] + " " + half["fr"]), (2, half["de"])]
    rows = {r.doc_id: r for r in langid.identify(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()}
    assert rows[1].n_languages == 2 and 0.4 < rows[1].score < 0.6
    assert rows[2].n_languages == 1 and rows[2].lang_pred == "de"


def test_em_finds_proportions():
    rng = np.random.default_rng(9)
    truth = rng.random(2000) < 0.3
    likelihood = np.where(np.stack([truth, ~truth], 1), 1.0, 0.05)
    shares = langid.language_sets(likelihood, np.array([0]))
    assert shares[0, 0] == pytest.approx(truth.mean(), abs=0.03)


# class model


def check_scores(docs):
    rows = docs.collect()
    held = [r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 1 for r in rows]
    tokens = [[*words(r.text), "\0end"] for r in rows]
    counts = collections.Counter(w for t, h in zip(tokens, held) if not h for w in t)
    n, v = sum(counts.values()), len(counts)
    wanted = sorted(
        (repr(r.doc_id), h, len(t), sum(counts[w] > 0 for w in t), n, round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), 6))
        for r, h, t in zip(rows, held, tokens)
    )
    found = brown.score_texts(docs, held_out(5)).collect()
    got = sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found)
    assert got == wanted
    assert all(r.score < 0 and r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens)) for r in found)
    return found


def test_scores_and_counts(given_docs):
    found = [r for r in check_scores(given_docs) if r.held_out]
    assert sum(r.score for r in found) > sum(r.base_score for r in found)


def test_words_beyond_the_head_are_joined(given_docs, monkeypatch):
    whole = {r.doc_id: r.score for r in brown.score_texts(given_docs, held_out(5)).collect()}
    monkeypatch.setattr(brown, "HEAD", 6000)
    found = check_scores(given_docs)
    # the same classes, as the exchanged words are all in the head
    assert {r.doc_id: pytest.approx(r.score) for r in found} == whole


def test_score_edge_cases(spark):
    check_scores(awkward_docs(spark))
    assert brown.score_texts(empty_docs(spark), held_out(5)).count() == 0


def test_emissions_and_transitions_are_probabilities(given_docs):
    vocabulary = brown.learn_vocabulary(given_docs, ~held_out(5))
    model = brown.fit_model(given_docs, ~held_out(5), vocabulary)
    assert (10**model.transition).sum(1) == pytest.approx(1.0)
    assert len(set(model.classes.tolist())) > 5
    mass = np.zeros(brown.CLASSES)
    top = brown.Lookup(vocabulary.head[: brown.EXCHANGED])
    rows = vocabulary.table.toPandas()
    kinds = model.classes[brown.unit_of(rows["hash"].to_numpy(np.int64).view(np.uint64), rows["ending"].to_numpy(np.int64), top)]
    np.add.at(mass, kinds, rows["n"].to_numpy() + 0.5)
    used = np.unique(kinds)
    unseen = 0.5
    assert (mass + unseen)[used] / 10 ** model.emission_total[used] == pytest.approx(1.0)


def test_lookup_finds_all_and_only_its_keys():
    rng = np.random.default_rng(10)
    keys = np.unique(rng.integers(0, 2**62, 5000).astype(np.uint64))
    lookup = brown.Lookup(keys)
    assert lookup.find(keys).tolist() == list(range(len(keys)))
    assert (lookup.find(keys + np.uint64(1)) == np.where(np.isin(keys + np.uint64(1), keys), 0, -1)).all()
    assert LOWER[ord("A")] == ord("a")
