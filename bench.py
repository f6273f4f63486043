"""Time the headline queries: one JSON line on stdout."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clusterloom.session import local_session  # noqa: E402

HEADLINE = [
    "prep_features", "kmeans_inertia", "kmeans_fit", "kmeans_predict", "fekm_farthest_pair", "fekm_sweep", "kernel_sweep",
    "fcm_fit", "gmm_inits", "agg_single", "agg_complete", "agg_average", "agg_ward", "pca_mean_cov", "pca_transform", "pca_then_fekm",
    "contingency", "davies_bouldin", "metric_suite", "matched_confusion", "sample_exact", "best_config", "fuzzifier_effect",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    from clusterloom.plans.catalogue import QUERIES

    names = sys.argv[1:] or HEADLINE
    spark.range(1).mapInArrow(lambda b: b, "id bigint").collect()  # start the Python workers
    taken = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        taken[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline queries, total wall time", "value": round(sum(taken.values()), 3), "unit": "sec", "queries": taken, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
