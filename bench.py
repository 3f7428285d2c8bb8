"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from catalog import QUERIES  # noqa: E402

# One or two per family of operators; every one runs over whole tables.
HEADLINE = [
    "rate_by_category",
    "rate_by_category_all",
    "rate_by_hour",
    "hour_verdict",
    "entity_rate",
    "rate_contribution",
    "adjusted_rate_table",
    "control_scenarios",
    "role_asymmetry",
    "top_routes",
    "numeric_summary",
    "describe_schema",
    "null_report",
    "iqr_outliers",
    "category_summary",
    "duplicate_count",
    "correlation_matrix",
    "audit_counts",
    "build_view",
    "one_hot_drop_first",
    "stratified_split",
    "stratified_kfold",
    "knn_classify",
    "knn_k_search",
    "tree_predict",
    "roc_curve",
    "auc_roc_fine",
    "classification_report",
    "histogram_bins",
    "density_curve",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ratewise-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    names = sys.argv[1:] or HEADLINE
    seconds: dict[str, float] = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
