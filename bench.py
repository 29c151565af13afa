"""Times the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from playledger.session import build_session  # noqa: E402
from queries import REGISTRY  # noqa: E402

HEADLINE = (
    "last_week_merged",
    "cleaned_plays",
    "plays_per_week",
    "songs_not_searched",
    "balances_merged",
    "prices_merged_if_changed",
    "dearest_line_per_order",
    "distinct_texts",
    "revenue_by_brand_and_nation",
    "cleaned_documents",
    "match_texts",
    "embedding_request_lines",
    "songs_matched_to_catalogue",
    "songs_matched_to_search_hits",
    "search_hit_rows",
    "normalized_words_per_line",
    "song_metadata",
    "extracted_results",
    "nearest_clusters",
    "refitted_clusters",
    "trait_scores",
    "integrity_report",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
