from pyspark.sql import functions as F

from playledger import schemas
from playledger.sinks import tables as sinks
from tests.conftest import rows


def test_only_touched_buckets_are_rewritten(spark, database):
    name = f"{database}.vectors"
    start = [(i, [float(i)]) for i in range(40)] + [(None, [0.5])]
    assert sinks.load_embeddings(spark.createDataFrame(start, schemas.EMBEDDINGS), name, only_if_changed=True, buckets=8) == {"INSERT": 41}
    files = {r[0]: r[1] for r in spark.table(name).select("key_bucket", F.col("_metadata.file_path")).distinct().collect()}
    same = spark.createDataFrame([(3, [3.0])], schemas.EMBEDDINGS)
    assert sinks.load_embeddings(same, name, only_if_changed=True) == {}
    fresh = spark.createDataFrame([(3, [9.0]), (77, [7.0]), (4, [4.0])], schemas.EMBEDDINGS)
    assert sinks.load_embeddings(fresh, name, only_if_changed=True) == {"INSERT": 1, "UPDATE": 1}
    wanted = {r[0]: r[1] for r in start} | {3: [9.0], 77: [7.0]}
    assert rows(spark.table(name), "id", "embedding") == sorted(wanted.items(), key=repr)
    after = {r[0]: r[1] for r in spark.table(name).select("key_bucket", F.col("_metadata.file_path")).distinct().collect()}
    home = {r["id"]: r["key_bucket"] for r in spark.table(name).collect()}
    assert {b for b in after if after[b] != files.get(b)} == {home[3], home[77]}


def test_every_matched_row_updates_and_nothing_in_nothing_out(spark, database):
    name = f"{database}.vectors"
    df = spark.createDataFrame([(1, [1.0]), (2, None)], schemas.EMBEDDINGS)
    assert sinks.load_embeddings(df.limit(0), name, only_if_changed=False, buckets=4) == {}
    assert sinks.load_embeddings(df.limit(0), name, only_if_changed=False) == {}
    assert sinks.load_embeddings(df, name, only_if_changed=False) == {"INSERT": 2}
    assert sinks.load_embeddings(df, name, only_if_changed=False) == {"UPDATE": 2}
    assert rows(spark.table(name), "id", "embedding") == [(1, [1.0]), (2, None)]
