import pytest

from playledger import schemas
from playledger.plans import vectors
from playledger.plans.tables import Tables
from playledger.sinks import publish as sink
from tests.conftest import rows


def frames(spark, database, value):
    return {
        f"{database}.labels": spark.createDataFrame([(i, value) for i in range(3)], schemas.LABELS),
        f"{database}.centers": spark.createDataFrame([(value, [float(value)])], schemas.CENTROIDS),
    }


def shown(spark, database):
    """The value that each of the two published tables shows; empty tables show none."""
    return [{r["cluster"] for r in spark.table(f"{database}.{name}").collect()} for name in ("labels", "centers")]


def test_both_tables_change_at_one_moment_whatever_step_fails(spark, database, monkeypatch):
    pointer = f"{database}.current"
    assert sink.publish(frames(spark, database, 1), pointer) == {f"{database}.labels": 3, f"{database}.centers": 1}
    assert shown(spark, database) == [{1}, {1}]
    steps = {"_versions_table": 2, "staged": 2, "_point": 1, "_drop_versions": 2}
    for step, calls in steps.items():
        for failing in range(calls):
            seen, real = [], getattr(sink, step)

            def fails(*args):
                seen.append(args)
                if len(seen) > failing:
                    raise OSError("driver lost")
                return real(*args)

            with monkeypatch.context() as patch:
                patch.setattr(sink, step, fails)
                with pytest.raises(OSError):
                    sink.publish(frames(spark, database, 2), pointer)
            assert shown(spark, database) == ([{2}, {2}] if step == "_drop_versions" else [{1}, {1}])
    sink.publish(frames(spark, database, 3), pointer)
    assert shown(spark, database) == [{3}, {3}]
    for name in ("labels", "centers"):
        assert spark.sql(f"SHOW PARTITIONS {database}.{name}__versions").count() == 2


def test_first_publication_that_fails_leaves_nothing_half(spark, database, monkeypatch):
    pointer, calls, real = f"{database}.current", [], sink._point

    def fails(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("driver lost")
        return real(*args)

    with monkeypatch.context() as patch:
        patch.setattr(sink, "_point", fails)
        with pytest.raises(OSError):
            sink.publish(frames(spark, database, 1), pointer)
    assert shown(spark, database) == [set(), set()]
    sink.publish(frames(spark, database, 2), pointer)
    assert shown(spark, database) == [{2}, {2}]


def test_readers_keep_their_version_and_scan_one(spark, database):
    pointer, name = f"{database}.current", f"{database}.labels"
    sink.publish(frames(spark, database, 1), pointer)
    begun = spark.table(name)
    sink.publish(frames(spark, database, 2), pointer)
    assert {r["cluster"] for r in begun.collect()} == {1}
    assert len(spark.table(name).inputFiles()) < len(spark.table(f"{name}__versions").inputFiles())
    version = sink.published_versions(spark, pointer)["labels"]
    plan = spark.table(name)._jdf.queryExecution().executedPlan().toString()
    assert version in plan and "ubquery" not in plan
    # a published table may be read by what replaces it
    sink.publish({name: spark.table(name).selectExpr("id", "cluster + 5 AS cluster")}, pointer)
    assert shown(spark, database) == [{7}, {2}]


def test_columns_grow_and_other_tables_are_refused(spark, database):
    pointer, name = f"{database}.current", f"{database}.labels"
    sink.publish({name: spark.createDataFrame([(1, 1)], schemas.LABELS)}, pointer)
    sink.publish({name: spark.createDataFrame([(1, 2, "x")], "id bigint, cluster bigint, `a b` string")}, pointer)
    assert rows(spark.table(name)) == [(1, 2, "x")]
    sink.publish({name: spark.createDataFrame([(4, 2)], schemas.LABELS)}, pointer)
    assert rows(spark.table(name)) == [(4, 2, None)]
    sink.publish({name: spark.createDataFrame([], schemas.LABELS)}, pointer)
    assert rows(spark.table(name)) == []
    for schema, told in (("id string", "other types"), (f"{sink.VERSION} string", "version column")):
        with pytest.raises(ValueError, match=told):
            sink.publish({name: spark.createDataFrame([], schema)}, pointer)
    spark.range(2).write.saveAsTable(f"{database}.plain")
    with pytest.raises(ValueError, match="plain table"):
        sink.publish({f"{database}.plain": spark.range(1)}, pointer)
    assert spark.table(f"{database}.plain").count() == 2


def test_published_clustering_stage(spark, database):
    tables = Tables(listening=database, library=database)
    points = [(1, [0.0, 0.0]), (2, [0.1, 0.0]), (3, [10.0, 10.0]), (4, [10.1, 10.0])]
    spark.createDataFrame(points, schemas.EMBEDDINGS).write.saveAsTable(tables.embeddings("clustering"))
    full = vectors.cluster_lyrics(spark, tables, replace_all=True, n_clusters=2, dim=2, published=True)
    assert full == {tables.centroids: 2, tables.clusters: 4}
    centers = rows(spark.table(tables.centroids))
    spark.createDataFrame([(5, [9.0, 9.0])], schemas.EMBEDDINGS).write.mode("append").saveAsTable(tables.embeddings("clustering"))
    assert vectors.cluster_lyrics(spark, tables, dim=2, published=True) == {tables.clusters: 1}
    assert vectors.cluster_lyrics(spark, tables, dim=2, published=True) == {}
    labels = dict(rows(spark.table(tables.clusters)))
    assert len(labels) == 5 and labels[5] == labels[3] and rows(spark.table(tables.centroids)) == centers
