"""Headline queries timed at one scale; prints one JSON line.

``BENCH_SF_DIR`` names the folder of tables and ``BENCH_CPUS`` the number of local cores.
"""

from __future__ import annotations

import json
import os
import time

from weirgate import registry
from weirgate.session import local_session

HEADLINE = [
    "kept_per_source",
    "repetition_filter",
    "quality_filter",
    "funnel_stage_counts",
    "token_totals",
    "captures_first_by_digest",
    "fetch_list",
    "fetch_list_after_run",
    "markup_cleaned",
    "main_texts",
    "url_path_words",
    "url_tfidf",
    "archive_slices",
    "duplicate_clusters",
    "dedup_by_source_then_all",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/documents.parquet").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    documents = spark.read.parquet(f"{folder}/documents.parquet").count()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "documents": documents,
                "documents_per_sec": {
                    n: round(documents / seconds[n], 1) for n in ("kept_per_source", "duplicate_clusters") if seconds[n]
                },
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
