"""The near-duplicate stage keeps one row of each class, whatever the rows' doc_ids."""

import corpus_pipeline

SCHEMA = "doc_id long, text string, node string, bands int"


def text(k, changed=""):
    return " ".join([*(f"w{k}x{i}" for i in range(120)), changed])


def test_rows_without_or_with_the_same_doc_id_are_in_the_classes_of_their_texts(spark):
    rows = [
        (1, text(1), "kept", 1), (2, text(1, "end"), "near", 2), (None, text(1, "other"), "near", 3), (None, text(1).upper(), "exact", 4),
        (2, text(2), "kept", 5),  # shares its doc_id with a near copy of another class
        (None, text(3), "either", 6), (None, text(3, "end"), "either", 7), (None, text(3), "either", 8),
        (7, text(4), "kept", 9), (7, text(5), "kept", 10), (7, text(5), "kept", 10),
        (None, None, "kept", 11), (8, "", "kept", 12), (8, "", "kept", 12),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = corpus_pipeline.keep_one_of_each_group(spark, docs, "")
    assert found.columns == docs.columns
    kept = [tuple(r) for r in found.collect()]
    assert all(r in rows for r in kept)
    assert sorted(r[3] for r in kept if r[2] == "kept") == [1, 5, 9, 10, 11, 12]
    assert [r[2] for r in kept if r[2] != "kept"] == ["either"]
