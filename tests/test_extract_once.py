import json
import os

import pytest

from playledger import schemas
from playledger.operators import embedding_jobs
from playledger.plans import vectors
from playledger.plans.tables import Tables
from playledger.sources.records import read_job_results
from tests.conftest import rows

FILES = "name string, file_name string, has_dest boolean"
JOB = "name string, state string"


def put(spark, path, vectors_by_job):
    lines = [
        (job, json.dumps({"key": str(i), "response": {"embedding": {"values": v}}}))
        for job, found in vectors_by_job.items()
        for i, v in found.items()
    ]
    df = spark.createDataFrame(lines, "job string, value string").repartition(1)
    df.write.mode("append").partitionBy("job").text(path)
    found = read_job_results(spark, path).select("job", "file_name").distinct().collect()
    return [(r["job"], r["file_name"], True) for r in found]


def test_files_are_loaded_once(spark, database, scratch, monkeypatch):
    tables, path = Tables(listening=database, library=database), f"{scratch}/results"
    names = ["batches/a-0", "batches/a-1", "batches/a-2"]
    states = ["JOB_STATE_SUCCEEDED", "JOB_STATE_SUCCEEDED", "JOB_STATE_RUNNING"]
    jobs = spark.createDataFrame([*zip(names, states), (None, "JOB_STATE_SUCCEEDED")], JOB)
    jobs.write.saveAsTable(tables.jobs())
    found = put(spark, path, {names[0]: {1: [1.0, 2.0], 2: [3.0, 4.0]}, names[1]: {}, names[2]: {9: [9.0, 9.0]}})
    files = spark.createDataFrame([*found, *found, (names[1], None, True), (None, "x", True)], FILES)

    def run(files=files):
        return vectors.extract_new_embeddings(spark, tables, path, files)

    with monkeypatch.context() as patch:
        patch.setattr(vectors, "append", lambda *_: pytest.fail("driver lost"))
        with pytest.raises(pytest.fail.Exception):
            run()
    assert run() == {"UPDATE": 2}  # not noted, so loaded again, by key
    assert run() == {}
    with monkeypatch.context() as patch:
        patch.setattr(vectors, "read_job_results", lambda *_: pytest.fail("results read"))
        assert run() == {}
    assert rows(spark.table(tables.embeddings()), "id", "embedding") == [(1, [1.0, 2.0]), (2, [3.0, 4.0])]
    more = put(spark, path, {names[1]: {2: [5.0, 5.0], 3: [6.0, 6.0]}})
    assert run(spark.createDataFrame(more, FILES)) == {"INSERT": 1, "UPDATE": 1}
    assert dict(rows(spark.table(tables.embeddings()), "id", "embedding"))[2] == [5.0, 5.0]
    assert {r[0] for r in rows(spark.table(tables.extracted()))} == set(names[:2])


@pytest.mark.parametrize("most", [10, 1])
def test_other_folders_stay_unread(spark, scratch, monkeypatch, most):
    monkeypatch.setattr(embedding_jobs, "MAX_BROADCAST_FILES", most)
    path = f"{scratch}/results"
    found = put(spark, path, {f"batches/{j}": {10 * j + i: [float(j)] for i in range(3)} for j in range(6)})
    files = spark.createDataFrame([f[:2] for f in sorted(found)[:2]] + [(None, "x")], schemas.EXTRACTED)
    if most == 10:  # a scan that meets this file fails
        os.makedirs(f"{path}/job=other")
        with open(f"{path}/job=other/part.json.gz", "wb") as f:
            f.write(b"no gzip member")
        with pytest.raises(Exception, match="(?i)gzip|read"):
            read_job_results(spark, path).collect()
    got = embedding_jobs.extract_files(files, 2, read_job_results(spark, path))
    assert rows(got, "id") == [(0,), (1,), (10,), (11,), (12,), (2,)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == (most == 10)
