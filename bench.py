"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from pyspark.sql import SparkSession

HEADLINE = [
    "general_metric_mart",
    "cutoff_metrics",
    "class_auc",
    "data_quality_profile",
    "data_distribution_mart",
    "ks_drift",
    "feature_drift_test",
    "feature_histograms",
    "correlation_matrix",
    "shap_summary",
    "stratified_split",
    "stratified_kfold",
    "encode_preprocess",
    "clip_outliers",
    "cumulative_share",
    "feedback_join",
    "keep_last",
    "rolling_bands",
    "clean_text",
    "tfidf",
]


def main() -> None:
    from driftwarden.catalog import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    line = {
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
