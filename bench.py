"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder and BENCH_CPUS the cores.  Each query runs
once, from the scan to a sink that takes every row, after a short warm-up.
"""

from __future__ import annotations

import json
import os
import sys
import time

from oreline.plans.registry import QUERIES
from oreline.session import local_session

HEADLINE = [
    "ngram_top5", "post_files_popularity", "posts_from_json", "posts_per_group", "distinct_tokens", "tokenizer_counts",
    "token_mentions_top20", "relative_popularity_top10", "conversation_popularity_top10",
    "entity_decode_counts", "panel_daily_stats", "scalar_summary", "clipped_histogram",
    "covariance_invariants", "reconstruct_residual", "residual_extremes", "ols_coefficients",
    "ols_ablation", "kmeans_assign_cost", "kmeans_pp_multi_run", "label_prefix_entropy",
    "class_distribution", "error_rate", "gbt_depth_sweep", "rf_depth_sweep",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, shuffle_partitions=cores, memory="16g")
    spark.read.parquet(f"{sf_dir}/region.parquet").groupBy("r_name").count().collect()
    took = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
        print(name, took[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(took.values()), 3),
                      "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
