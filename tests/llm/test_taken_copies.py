"""Each document is taken by the copies of its own doc_id, source and size."""

import collections

import pytest
from pyspark.sql import functions as F

from playledger.llm import mixing

SCHEMA = "doc_id long, text string, source string"


def keyed(rows):
    return {(r.doc_id, r.source, r["size"]): r.n for r in rows}


@pytest.mark.parametrize("part_bits", [mixing.PART_BITS, 62])
def test_rows_alike_in_doc_id_alone_do_not_share_copies(spark, monkeypatch, part_bits):
    monkeypatch.setattr(mixing, "PART_BITS", part_bits)
    rows = [(None, " ".join(["w"] * n), s) for n in range(1, 8) for s in ("a", "b", None)]
    rows += [(None, f"u{k} v{k} w{k}", "a") for k in range(25)]
    rows += [(5, "one two", "a"), (5, "one two three", "a"), (5, "one two", "b"), (5, "x y", "a"), (6, "p q", "b"), (6, "p q", "b")]
    docs = spark.createDataFrame(rows, SCHEMA)
    taken = mixing.take_mixture(docs).cache()
    wanted = keyed(mixing.mixed_sizes(docs).groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("n")).filter("n > 0").collect())
    got = keyed(taken.groupBy("doc_id", "source", mixing.word_count().cast("long").alias("size")).agg(F.count(F.lit(1)).alias("n")).collect())
    assert got == wanted
    per_key = collections.defaultdict(list)
    held = collections.Counter((r.doc_id, r.source, r.text) for r in taken.collect())
    for r in set(rows):
        per_key[r[0], r[2], len(r[1].split())].append(held[r[0], r[2], r[1]] / rows.count(r))
    assert all(max(x) - min(x) <= 1 for x in per_key.values())
