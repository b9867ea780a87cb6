"""Times the headline queries: one warm-up, then the median of three runs, in seconds.

Prints one JSON line. ``BENCH_SF_DIR`` is the data folder, ``BENCH_CPUS`` the cores,
``BENCH_QUERIES`` a comma separated choice of queries, ``BENCH_RUNS`` the timed runs.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from pathlib import Path

from pyspark.sql import SparkSession

from newsloom.plans.queries import QUERIES

HEADLINE = (
    "trending_words", "trending_words_compat", "trending_tokens_raw", "top20_keywords",
    "category_keywords", "token_class", "dedup_first_wins", "mark_duplicates", "dedup_new_items",
    "process_articles", "page_text", "page_links", "ingest_articles", "ingestion_log",
    "logs_page", "assign_ids", "merge_phrases", "stream_trending",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.sql.shuffle.partitions", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(cpus)
    times = {}
    for name in names:
        run(spark, name, folder)
        times[name] = round(statistics.median(run(spark, name, folder) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": Path(folder).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
