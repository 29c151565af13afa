"""Every query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from compare import normal

SF_DIR = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    ours = [tuple(row) for row in df.collect()]
    assert ours
    if name in SQL:
        result = duck.sql(SQL[name])
        theirs = result.fetchall()
        assert sorted(df.columns) == sorted(result.columns)
        assert normal(df.columns, ours) == normal(result.columns, theirs)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_refitted_clusters_cover_every_vector(spark):
    """Same seed, same labels; every label is one of seven and every vector has one."""
    run = entry.queries()["refitted_clusters"]
    first = {r["id"]: r["cluster"] for r in run(spark, SF_DIR).collect()}
    vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").count()
    assert len(first) == vectors and set(first.values()) == set(range(7))
    assert first == {r["id"]: r["cluster"] for r in run(spark, SF_DIR).collect()}
