"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the data
and the cores. Every query runs once to warm up and is then timed on a full write to
the noop sink, plan construction and its eager steps included.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from tidemark.plans.catalog import QUERIES

HEADLINE = (
    "next_slice",
    "slice_metadata",
    "snapshot_diff",
    "validate_triple",
    "quarantine",
    "global_split",
    "per_user_split",
    "last_n_per_user",
    "masked_sequences",
    "item_vocab",
    "candidate_pairs",
    "next_item_recs",
    "enrich",
    "candidate_eval",
    "ndcg_at_k",
    "drift_ks",
    "batch_monitoring",
    "promotion_history",
    "mf_predictions",
)


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        run(spark, name, sf_dir)
        seconds[name] = round(run(spark, name, sf_dir), 3)
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
