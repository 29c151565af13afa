"""Values counted per parent: one row per parent is shuffled, and parents of several batches or records are merged."""

from collections import defaultdict

from pyspark.sql import functions as F

from playledger.operators.normalize import count_values, normalize


def test_values_are_counted_per_parent(spark):
    words = [(1, ["a", "b", "a", None, None]), (2, [f"w{i % 700}" for i in range(30_000)]), (3, []), (4, None), (1, ["c", "a"])]
    given = spark.createDataFrame(words, "id bigint, words array<string>").repartition(3)
    children = normalize(given, "docs", ["id"])["docs__words"]
    wanted = defaultdict(list)
    for row in children.collect():
        wanted[row["_dlt_parent_id"]].append(row["value"])
    found = {r["_dlt_parent_id"]: (r["rows"], r["distinct_values"]) for r in count_values(children).collect()}
    assert found == {k: (len(v), len(set(v))) for k, v in wanted.items()}
    assert sorted(found.values()) == [(7, 4), (30_000, 700)]


def test_no_row_per_value_is_shuffled(spark):
    given = spark.range(50).select("id", F.transform(F.sequence(F.lit(1), F.lit(400)), lambda x: x.cast("string")).alias("words"))
    counted = count_values(normalize(given, "docs", ["id"])["docs__words"])
    counted.collect()
    plan = counted._jdf.queryExecution().executedPlan()
    shuffled = []

    def walk(node):
        if "ShuffleExchangeExec" in node.getClass().getName():
            shuffled.append(node.metrics().get("shuffleRecordsWritten").get().value())
        for inner in ("executedPlan", "plan"):
            if inner == "executedPlan" and "AdaptiveSparkPlanExec" in node.getClass().getName() or inner == "plan" and "QueryStageExec" in node.getClass().getName():
                walk(getattr(node, inner)())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan)
    assert shuffled and sum(shuffled) < 1_000
