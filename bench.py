"""Seconds per headline query, as one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

``BENCH_NAIVE=1`` also times the plain forms of the rewritten operators (use it at
sf0.01: the plain title match takes very long beyond); ``BENCH_QUERIES``
(comma-separated) picks queries, of both kinds.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import SparkSession

from driver.naive import NAIVE
from driver.queries import QUERIES

HEADLINE = [
    "q_keep_one", "q_review_agg", "q_band_join", "q_or_join", "q_star_join", "q_batches", "q_slug",
    "q_multi_date", "q_title_tokens", "q_roundtrip_multiline", "q_extract_class", "q_classify",
    "q_word_freq", "q_word_freq_paired", "q_stopword_anti", "q_top_words", "q_tfidf", "q_credits",
    "q_title_match", "q_best_match", "q_movie_table", "q_outcome_rows", "q_batches_input_order",
    "q_credits_recovered", "q_roundtrip_one_csv", "q_pipeline",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ratingscope-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        # Small tables: let each core have a part of them.
        .config("spark.sql.files.maxPartitionBytes", "4m")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_orderstatus").count().collect()

    def seconds(query) -> float:
        start = time.perf_counter()
        query(spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINE
    times = {name: seconds(QUERIES[name]) for name in names}
    scale = re.search(r"sf([0-9.]+)", folder)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(scale.group(1)) if scale else None,
    }
    if os.environ.get("BENCH_NAIVE") == "1":
        result["naive"] = {name: seconds(query) for name, query in NAIVE.items() if name in names}
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
