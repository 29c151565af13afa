"""Vector searches, host verdicts and the pipeline against plain loops."""

import collections
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from playledger.llm import host_graph, rp_forest, segment_topk
from playledger.llm.queries import QUERIES, RULES, SQL
from tests.llm.fixtures import DOC_SCHEMA, awkward_docs, empty_docs

VECTORS = "vec_id long, embedding array<float>, rank int"


def awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(k, [float(k % 7), float(k % 3), 1.0, -0.5 * (k % 5)], 1) for k in range(40)]
    rows += [(100, None, 1), (101, [1.0, None, 0.0, 0.0], 1), (102, [nan, 1.0, 0.0, 0.0], 1), (103, [inf, 1.0, 0.0, 0.0], 1)]
    rows += [(104, [0.0] * 4, 1), (None, [1.0] * 4, 1), (0, [0.0, 0.0, 1.0, 0.0], 1)]
    return spark.createDataFrame(rows, VECTORS)


def brute_nearest(ids, vectors, query, k):
    far = np.sqrt(((vectors - vectors[ids == query][0]) ** 2).sum(1))
    order = [i for i in np.lexsort((ids, far)) if ids[i] != query][:k]
    return [(int(ids[i]), far[i]) for i in order]


def test_nearest_reaches_recall(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    frame = rows.toPandas()
    ids, vectors = frame["vec_id"].to_numpy(), np.stack(frame["embedding"]).astype(float)
    found = rp_forest.nearest(rows, rows.filter("vec_id % 100 = 0"), 10).toPandas()
    hits = total = 0
    for query in ids[ids % 100 == 0]:
        part = found[found["query_id"] == query].sort_values("rank")
        wanted = brute_nearest(ids, vectors, query, 10)
        hits += len({i for i, _ in wanted} & set(part["vec_id"]))
        total += len(wanted)
        exact = np.sqrt(((vectors[np.searchsorted(ids, part["vec_id"])] - vectors[ids == query]) ** 2).sum(1))
        assert part["score"].to_numpy() == pytest.approx(exact, abs=1e-12)
        assert part["rank"].tolist() == list(range(1, len(part) + 1))
    assert hits / total >= 0.9


def test_nearest_edge_cases(spark):
    rows = awkward_vectors(spark)
    found = rp_forest.nearest(rows, rows.filter("vec_id in (0, 7, 100, 103, 104)"), 5)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    frame = rows.filter("vec_id < 40").dropDuplicates(["vec_id"]).orderBy("vec_id").toPandas()
    ids, vectors = frame["vec_id"].to_numpy(), np.stack(frame["embedding"]).astype(float)
    got = collections.defaultdict(list)
    for r in found.orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == {0, 7}
    for query, part in got.items():
        wanted = brute_nearest(ids, vectors, query, 5)
        assert [i for i, _ in part] == [i for i, _ in wanted]
        assert [s for _, s in part] == pytest.approx([s for _, s in wanted])
    none = spark.createDataFrame([], VECTORS)
    assert rp_forest.nearest(none, none, 5).count() == 0
    few = rows.filter("vec_id in (1, 2)")
    assert rp_forest.nearest(few, few, 5).count() == 2


def test_copies_of_one_vector_are_searched_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(rp_forest, "BLOCK_ROWS", 16)
    rows = spark.createDataFrame([(k, [1.0, 2.0, 3.0]) for k in range(200)], "vec_id long, embedding array<float>")
    found = rp_forest.nearest(rows, rows.filter("vec_id % 100 = 0"), 10).orderBy("query_id", "rank").collect()
    assert [r.vec_id for r in found] == [*range(1, 11), *range(0, 10)]


def test_queue_opens_the_nearest_region_first():
    rng = np.random.default_rng(1)
    sample = rng.normal(size=(600, 8)).astype(np.float32)
    forest = rp_forest.build_forest(sample, 4)
    own = rp_forest.leaves(forest, sample[:1])[0]
    found = rp_forest.search(forest, sample[0], 10_000)
    assert [(t, leaf) for t, leaf, _ in found[: rp_forest.TREES]] and len(found) == rp_forest.TREES * 16
    assert {(t, int(own[t])) for t in range(rp_forest.TREES)} == {(t, leaf) for t, leaf, _ in found[: rp_forest.TREES]}


def test_bounds_are_never_below_the_score():
    rng = np.random.default_rng(2)
    a, b = rng.integers(-50, 50, (30, 13)), rng.integers(-50, 50, (40, 13))
    score = segment_topk.inner_products(a, b)
    bounds = [segment_topk.summary(a, s) @ segment_topk.summary(b, s).T for s in (1, 2, 8, 13)]
    for bound in bounds:
        assert (bound >= score - 1e-6).all()
    assert bounds[-1] == pytest.approx(score)


def test_pruning_loses_nothing(monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(segment_topk, "AT_ONCE", (7, 16))
    base = np.repeat(rng.integers(-60, 60, (20, 4)), 4, axis=1)
    rows = base[rng.integers(0, 20, 300)] + rng.integers(-2, 3, (300, 16))
    ids = rng.permutation(300)
    q, r, s = segment_topk.block_top(ids, rows, ids[:25], rows[:25], 6)
    for k in range(25):
        score = rows @ rows[k]
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != ids[k]][:6]
        assert r[q == k].tolist() == order and s[q == k].tolist() == score[order].tolist()


def test_large_components_stay_exact():
    a = np.array([[2**28, 1]], np.int64)
    b = np.array([[2**28, 1]], np.int64)
    assert segment_topk.inner_products(a, b)[0, 0] == 2**56 + 1


def test_topk_is_that_of_sql(spark, monkeypatch):
    monkeypatch.setattr(segment_topk, "BLOCK_ROWS", 100)
    monkeypatch.setattr(segment_topk, "QUERY_ROWS", 10)
    found = QUERIES["op8_segment_topk"](spark, "/root/testdata/sf0.01").toPandas()
    con = duckdb.connect()
    con.execute("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.01/embeddings.parquet'")
    wanted = con.execute(SQL["op8_segment_topk"]).df()
    keys = ["query_id", "rank"]
    assert found.sort_values(keys).to_numpy().tolist() == wanted.sort_values(keys).to_numpy().tolist()


def test_topk_edge_cases(spark):
    vectors = segment_topk.integer_vectors(awkward_vectors(spark))
    assert sorted(r.vec_id for r in vectors.collect()) == [*range(40), 104]
    found = segment_topk.top_products(vectors, vectors.filter("vec_id in (3, 104)"), 50)
    assert found.filter("query_id = 3").count() == 40 and found.filter("query_id = vec_id").count() == 0
    tied = [r.vec_id for r in found.filter("query_id = 104").orderBy("rank").collect()]
    assert tied == list(range(40))
    none = segment_topk.integer_vectors(spark.createDataFrame([], VECTORS))
    assert segment_topk.top_products(none, none, 5).count() == 0


# hosts


def brute_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def brute_rule(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


URLS = [
    "http://A.Example.ORG/es/x", "https://example.org/en/12?q#f", "https://example.org/en/2", "http://org/", "http://x.org", "http://sub.b.com/de/1",
    "http://b.com/fr/2#/de/", "http://B.com?x=/fr/", "notaurl", None, "", "://", "x://y.org?://z.com/de/", "ftp://borg/de/", "http://com/fr/://a/de/", "http://é.com/fr/",
]


def test_rules_are_those_of_the_longest_match(spark):
    rows = [(k, u, None, "x", "y") for k, u in enumerate(URLS)] + [(0, URLS[0], None, "x", "y"), (None, URLS[5], "<a href=//b.com>", "x", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, verdict string")
    found = host_graph.judge(pages, RULES).collect()
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in found), key=repr)
    for page_id, host, path, rule, verdict in got:
        wanted = brute_rule(host, path)
        assert rule == (wanted.name if wanted else None)
        assert verdict == wanted.verdict if wanted else verdict in ("allow", "block")
    assert [g[:3] for g in got] == sorted(((r[0], *brute_url(r[1])) for r in rows), key=repr)
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert host_graph.judge(empty, RULES).count() == 0


def test_trust_follows_links_and_distrust_goes_against_them(spark):
    link = '<a href="http://{}/x">y</a> <img src=//{}:80/>'
    pages = [
        (1, "http://good.org/a", link.format("liked.net", "liked.net")),
        (2, "http://liked.net/a", link.format("further.net", "further.net")),
        (3, "http://bad.com/de/1", link.format("victim.net", "victim.net")),
        (4, "http://praises.net/1", link.format("bad.com", "bad.com")),
        (5, "http://further.net/a", None),
        (6, "http://victim.net/a", ""),
        (7, "http://alone.net/a", "<a href='/local'>"),
    ]
    found = {r.page_id: r for r in host_graph.judge(spark.createDataFrame(pages, "page_id long, url string, html string"), RULES).collect()}
    assert [found[k].verdict for k in range(1, 8)] == ["allow", "allow", "block", "block", "allow", "allow", "allow"]
    assert found[2].trust > found[5].trust > 0 and found[4].distrust > 0 and found[6].distrust == 0


def test_ranks_are_those_of_power_iteration(spark):
    rng = np.random.default_rng(4)
    n = 12
    weight = rng.integers(0, 4, (n, n)) * (1 - np.eye(n, dtype=int))
    edges = [(f"h{a}", f"h{b}", int(weight[a, b])) for a in range(n) for b in range(n) if weight[a, b]]
    frame = spark.createDataFrame(edges, "src string, dst string, n long")
    seeds = spark.createDataFrame([("h0", 0.75), ("h3", 0.25)], "host string, seed double")
    found = {r["host"]: r["rank"] for r in host_graph.spread(host_graph._shares(frame, "src", "dst"), seeds, 5).collect()}
    seed = np.zeros(n)
    seed[[0, 3]] = 0.75, 0.25
    share = weight / np.maximum(1, weight.sum(1, keepdims=True))
    rank = seed.copy()
    for _ in range(5):
        rank = 0.15 * seed + 0.85 * share.T @ rank
    assert [found.get(f"h{k}", 0.0) for k in range(n)] == pytest.approx(rank.tolist())


# pipeline


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sf = "/root/testdata/sf0.001"
    kept = dict(corpus_pipeline.STAGES)
    assert list(kept) == ["language", "near_duplicates", "mixture", "packing"]
    known = kept["language"](spark, docs.unionByName(docs.limit(1).withColumn("text", F.lit("12 ..")).withColumn("doc_id", F.lit(-1).cast("long"))), sf)
    assert known.columns == docs.columns and known.filter("doc_id = -1").count() == 0
    assert known.count() >= 0.97 * docs.count()
    one = kept["near_duplicates"](spark, known, sf)
    from playledger.llm.prob_minhash import near_duplicates

    assert sorted(r.doc_id for r in one.collect()) == sorted({r.class_id for r in near_duplicates(known).collect()})
    mixed = kept["mixture"](spark, one, sf)
    assert mixed.columns == docs.columns and mixed.count() > 0
    packed = kept["packing"](spark, mixed, sf)
    assert packed.filter("piece = 0").count() == mixed.count()
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_stages_bear_awkward_rows(spark):
    for docs in (awkward_docs(spark), empty_docs(spark)):
        frame = docs
        for _, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, "/root/testdata/sf0.001")
            frame = spark.createDataFrame(frame.collect(), frame.schema)
        assert "sequence_id" in frame.columns
    assert DOC_SCHEMA and isinstance(pa.array([1]), pa.Array)
