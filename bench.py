"""Benchmark: headline analyses at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each analysis is run to completion through the no-op sink (the whole plan
executes, nothing is collected) and timed; one JSON line is printed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "e1_precision_by_threshold",
    "a9_top_k_per_key",
    "n1_knn_exact_join",
    "n1_knn_exact_join_blocked",
    "n5_knn_classifier",
    "r1_top_items_per_user",
    "r3_approx_top_n_block_quota",
    "g3_shortest_paths",
    "g5_triangles",
    "g8_components_5nn",
    "d1_dbscan",
    "q3_frequent_itemsets",
    "m2_fm_gradient",
    "m14_regression_table_scoring",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tessera.session import build_session
    spark = build_session(master=f"local[{cpus}]", app="tessera-bench",
                          shuffle_partitions=int(cpus))
    from tessera.plans.catalog import queries
    qs = queries()
    # untimed warm-up: JVM code paths and the Python worker pool start once
    t0 = time.time()
    qs["e1_precision_by_threshold"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    warmup = round(time.time() - t0, 3)
    times = {}
    for key in HEADLINE:
        t0 = time.time()
        qs[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[key] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_headline_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "warmup_sec": warmup}))
    spark.stop()


if __name__ == "__main__":
    main()
