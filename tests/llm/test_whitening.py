"""Whitening against the covariance of the distinct vectors in whole numbers."""

import numpy as np
import pytest

from playledger.llm import whitening
from playledger.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<double>, x int, component int"


def held_to_covariance(rows, found, k=16):
    """`rows`: (vec_id, vector), ids distinct. Holds every column to plain numpy on whole numbers."""
    whole = {i: [int(np.floor(64 * float(c))) + 1_000_000 for c in v] for i, v in rows}
    fitted = np.unique(np.array(list(whole.values()), np.int64), axis=0)
    n, sums = len(fitted), fitted.sum(0)
    centred = (n * fitted - sums).astype(object)
    covariance = (centred.T @ centred).astype(float) / n**3
    values, components = np.linalg.eigh(covariance)
    values, components = values[::-1], components[:, ::-1]
    k = min(k, fitted.shape[1])
    assert len(found) == len(rows) * k
    assert set(found["n"]) == {n}
    assert found["identity_error"].max() <= 1e-4
    for component in range(1, k + 1):
        part = found[found["component"] == component].set_index("vec_id").sort_index()
        ids = part.index.tolist()
        assert ids == sorted(whole)
        assert part["deviation"].tolist() == [sum((n * c - int(s)) ** 2 for c, s in zip(whole[i], sums)) for i in ids]
        share = values[component - 1] / values.sum()
        if share < 1e-13:
            assert part["whitened"].isna().all() and (part["explained"] == 0).all()
            continue
        assert part["explained"].to_numpy() == pytest.approx(share, rel=1e-9)
        x = np.array([whole[i] for i in ids], np.int64)
        wanted = (x - sums / n) @ components[:, component - 1] / np.sqrt(values[component - 1])
        got = part["whitened"].to_numpy()
        sign = np.sign(got @ wanted)
        assert got == pytest.approx(sign * wanted, abs=1e-7)


def test_whole_table(spark):
    found = QUERIES["op12_shifted_cholesky"](spark, "/root/testdata/sf0.01")
    assert [(f.name, f.dataType.simpleString()) for f in found.schema] == [
        ("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"),
        ("whitened", "double"), ("explained", "double"), ("identity_error", "double"),
    ]
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    held_to_covariance([(r.vec_id, r.embedding) for r in rows], found.toPandas())


def test_without_full_rank_and_with_copies(spark):
    draw = np.random.default_rng(5)
    vectors = draw.normal(size=(200, 6)) * [1, 100, 1e-2, 1, 1, 1]
    vectors[:, 5] = vectors[:, 0]
    vectors[:, 4] = 2.0
    vectors[50:120] = vectors[0]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    odd = [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [float("nan")] * 6), (903, [float("inf")] * 6), (904, [1.0, 2.0]), (905, [])]
    frame = spark.createDataFrame([(*r, 1, None) for r in rows + odd], VECTORS)
    held_to_covariance(rows, whitening.whitened_components(frame).toPandas())


def test_badly_conditioned_rows(spark):
    """Singular values over seven powers of ten: one Gram matrix alone would lose the small ones."""
    draw = np.random.default_rng(6)
    turn, _ = np.linalg.qr(draw.normal(size=(5, 5)))
    whole = np.floor((draw.normal(size=(400, 5)) * [1e9, 1e6, 1e4, 300, 30]) @ turn)
    distinct = spark.createDataFrame([(v.astype(np.int64).tolist(),) for v in np.unique(whole, axis=0)], "x array<bigint>")
    model = whitening.fit(distinct)
    exact = np.linalg.svd(whole - whole.mean(0), compute_uv=False) ** 2 / len(whole)
    assert model.variances == pytest.approx(exact, rel=1e-6)
    assert whitening.identity_error(distinct, model, 5) < 1e-6


def test_few_rows_and_repeated_ids(spark):
    def found(rows):
        return whitening.whitened_components(spark.createDataFrame([(*r, 1, 1) for r in rows], VECTORS)).toPandas()

    assert len(found([])) == 0
    assert len(found([(1, [])])) == 0
    one = found([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0])])
    assert len(one) == 6 and one["whitened"].isna().all() and set(one["n"]) == {1} and one["identity_error"].isna().all()
    two = found([(1, [1.0, 2.0]), (1, [5.0, 2.0]), (None, [1.0, 2.0])])
    first = two[two["component"] == 1]
    assert sorted(first["whitened"].abs()) == pytest.approx([1, 1, 1])


def test_deviations_beyond_a_long_are_null(spark):
    rows = [(i, [1e13 * i, 1.0]) for i in range(3)]
    found = whitening.whitened_components(spark.createDataFrame([(*r, 1, 1) for r in rows], VECTORS)).toPandas()
    assert found["deviation"].isna().sum() == 4
