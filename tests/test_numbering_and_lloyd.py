import numpy as np
from pyspark.sql import functions as F

from playledger.operators import lloyd
from playledger.operators.numbering import numbered
from tests.conftest import rows

VECTORS = "id long, embedding array<double>"


def test_numbers_are_gapless_under_a_hot_key_and_nulls(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 != 0, F.lit(7)).alias("k"), F.col("id").alias("range"))
    got = numbered(df, [F.asc_nulls_last("k")], "n", start=5).collect()
    assert sorted(r["n"] for r in got) == list(range(5, 3005))
    assert sorted(r["range"] for r in got) == list(range(3000))
    assert all((r["k"] is None) == (r["n"] >= 2005) for r in got)


def test_numbers_of_equal_rows_and_of_none(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), (None,)], "k string")
    assert rows(numbered(df, ["k"])) == [("a", 1), ("a", 2), ("b", 3), (None, 0)]
    assert numbered(df.where("k = 'z'"), ["k"]).count() == 0


def test_a_step_is_the_mean_of_what_is_nearest(spark):
    points = np.random.default_rng(4).normal(size=(200, 3))
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)] + [(999, None)], VECTORS)
    centers = np.array([[0.5, 0, 0], [-0.5, 0, 0], [90.0, 90, 90]])
    near = ((points[:, None] - centers) ** 2).sum(axis=2).argmin(axis=1)
    wanted = [points[near == 0].mean(axis=0), points[near == 1].mean(axis=0), centers[2]]
    stored = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centers)], "cluster long, centroid array<double>")
    got = {r["cluster"]: r["centroid"] for r in lloyd.lloyd_step(df, stored).collect()}
    assert all(np.allclose(got[i], wanted[i]) for i in range(3))


def test_refit_finds_two_far_groups_in_any_layout(spark):
    points = [(i, [float(i % 2) * 100 + i % 5, 1.0]) for i in range(60)]
    df = spark.createDataFrame(points * 2, VECTORS)
    one = rows(lloyd.refit(df, 2, seed=3))
    assert sorted(c[1][0] for c in one) == [2.0, 102.0]
    assert one == rows(lloyd.refit(df.repartition(7), 2, seed=3))
