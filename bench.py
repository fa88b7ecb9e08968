"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) select
the data and the number of local cores. Every result is written to a sink that
keeps nothing, so each query is evaluated in full.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plumbline.plans.queries import QUERIES  # noqa: E402

HEADLINE = (
    "band_count_dense",
    "quantile_band",
    "clean_join",
    "feature_sets_written",
    "ordinal_encode",
    "auto_encode",
    "poly_full",
    "standardize",
    "preprocess",
    "mean_by_hue",
    "histogram",
    "histogram_hue",
    "facet_bins",
    "pairwise_scatter",
    "target_correlation",
    "associations",
    "profile_numeric",
    "compare_segments",
    "univariate_numeric_target",
    "kfold",
    "repeated_kfold_sizes",
    "score_metrics",
    "pareto_front_lines",
    "ridge_fit",
    "subset_search_ridge",
    "tune_ridge",
    "tree_rules",
    "forest_fit",
    "boruta",
    "pareto_front",
    "tune_boosted_trees",
    "subset_search_tree",
    "svr_kernel",
    "gbt_reg",
    "gbt_clf",
    "leaderboard",
    "wide_products",
)


def run(names, sf_dir: str, cpus: int) -> dict[str, float]:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    return times


if __name__ == "__main__":
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    seconds = run(sys.argv[1:] or HEADLINE, folder, int(os.environ.get("BENCH_CPUS", "8")))
    scale = re.search(r"sf([\d.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale[1]) if scale else None,
            }
        )
    )
