"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each query is executed fully with the ``noop`` sink (no rows are brought to the driver) after a
warm-up of the session. ``value`` is the sum of the per-query wall-clock seconds.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "flagship_fill_cap_profile",   # M1 -> O5 -> D25
    "d14_missing_by_column",
    "d17_describe",
    "d18_moments_normality",
    "d23_histogram",
    "c01_target_correlations",
    "c05_binary_phi_pairs",
    "c14_anova_f",
    "o05_cap_iqr",
    "o03_remove_outliers",
    "m11_ks_two_sample",
    "m12_variant_quality",
    "e02_grid_threshold_search",
    "e03_exact_threshold_search",
    "e08_auc",
    "e13_evaluate_at_saved_thresholds",
    "r01_stratified_split",
    "t01_yeo_johnson_fit_apply",
    "m03_knn_impute",
    "b01_frozen_preprocessing",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from adlytics.catalog import registry
    from adlytics.session import get_spark
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                      extra={"spark.driver.memory": "16g"})
    queries, _ = registry.load_all()
    spark.range(1000).selectExpr("sum(id)").collect()  # warm-up
    times = {}
    for name in HEADLINE:
        if name not in queries:
            continue
        t0 = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = sf_dir.rstrip("/").split("sf")[-1]
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf}))


if __name__ == "__main__":
    main()
