"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from calibra.plans import QUERIES  # noqa: E402
from calibra.session import local_session  # noqa: E402

HEADLINE = [
    "imputed_order_profile",
    "null_report",
    "fill_group_median",
    "ffill_by_user",
    "interpolate_by_user",
    "dedupe_by_key",
    "check_identity",
    "iqr_report",
    "iqr_drop",
    "describe_numeric",
    "describe_all",
    "corr_matrix",
    "histogram",
    "box_stats",
    "pivot_mean",
    "group_profile",
    "profile",
    "standardize",
    "polynomial",
    "label_encode_many",
    "pca",
    "split_stratified",
    "folds",
    "classification_report",
    "auc_ovr",
    "regression_metrics",
    "adjusted_rand",
    "knn",
    "silhouette",
    "dbscan",
    "relabel",
    "kmeans",
    "fuzzy_step",
    "ridge_one_feature",
    "logistic_log_odds",
    "tree_model",
]


def run(spark, name, directory):
    """Seconds to compute the whole result, which stays on the executors."""
    start = time.perf_counter()
    QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main():
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, cpus)
    run(spark, "head", directory)
    run(spark, "inertia", directory)
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    seconds = {name: round(run(spark, name, directory), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(Path(directory).name.removeprefix("sf") or 0),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
