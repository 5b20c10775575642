"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is fully materialised with the ``noop`` sink (every row computed,
nothing collected to the driver). One warm-up run of the flagship query
precedes the timings. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "flagship_label_profile",
    "p5_describe",
    "c1_remove_duplicates",
    "c3_impute_median",
    "c5_impute_knn",
    "c8_outliers_iqr",
    "f8_stratified_split",
    "f10_three_way_split",
    "f11_feature_pipeline",
    "f12_gaussian_noise",
    "a5_roc_auc",
    "a7_evaluate_model",
    "a11_spearman",
    "a13_quartile_misclassification",
    "r4_standards_alignment",
    "h4_standards_exceedance",
    "m9_m10_isolation_forest",
    "h2_stream_window_monitor",
    "h3_stream_dedupe",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from quench.plans.catalog import QUERIES
    from quench.session import get_spark

    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app="quench-bench")
    only = os.environ.get("BENCH_ONLY")
    names = [n for n in HEADLINE if not only or n in only.split(",")]
    from quench.sources.fixtures import measurements

    # the four-way join, hashed and written once: timed as a line of its own
    t0 = time.time()
    measurements(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {"ingest_measurements": round(time.time() - t0, 3)}
    QUERIES["flagship_label_profile"].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in names:
        t0 = time.time()
        QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_headline_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
