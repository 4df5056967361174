"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma-separated names)
"""

from __future__ import annotations

import json
import os
import sys
import time

from punctual.catalog import REGISTRY
from punctual.session import build_session

HEADLINE = [
    # profiles and ranked tables
    "missing_profile", "duplicate_keys", "distinct_counts", "zero_negative_profile", "stratum_share", "top_groups", "worst_routes",
    "group_means", "hourly_mean",
    # samples, splits, indexes
    "stable_sample", "stable_limit", "stratified_split", "global_index", "semi_rows_of_dup_keys", "duplicate_rows",
    # codes, features, outliers, coherence
    "replace_codes", "resolve_fanout", "clock_minutes_wrapped", "known_delay", "exact_quantiles", "quartile_report", "box_stats",
    "clock_diff_histogram", "time_order_rules",
    # encoding and association
    "onehot", "freq_encode", "freq_unseen_fill", "standard_scale", "tokens", "pearson_long", "spearman_long", "spearman_rank",
    "category_means",
    # clusters and models
    "cluster_share", "cluster_top10", "dominant_by_route", "silhouette", "kmeans_assign", "k_sweep", "category_embed", "ols_one_feature", "ols_two_features",
    "regression_metrics", "tree_fit", "tree_nodes", "lasso_select", "lasso_optimal",
    # whole paths
    "modelling_tables", "graph_prep",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_linenumber").count().collect()  # start the executors
    seconds = {}
    for name in names:
        start = time.perf_counter()
        REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"), "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
