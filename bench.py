"""Timings of the headline queries as one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local threads.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from tablevet.plans.queries import REGISTRY

HEADLINE = [
    "gate_outcomes",
    "gate_outcomes_large",
    "column_profile",
    "dataset_profile",
    "dataset_metrics",
    "duplicate_rows",
    "clean_fleet",
    "clean_classification",
    "clean_regression",
    "csv_fleet_cells",
    "catalog_flat",
    "manifest",
    "match_collections",
    "match_criteria_table",
    "collection_bounds",
    "academic_join",
    "top_popular",
    "preferred_sort",
    "split_80_20",
    "classification_scores",
    "roc_auc",
    "regression_scores",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tablevet-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tablevet-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Starts the JVM's code paths; not timed.
    REGISTRY["match_collections"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    seconds = {}
    for name in names:
        start = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
