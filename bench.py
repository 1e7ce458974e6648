"""Benchmark the headline queries.

Runs each query end to end (plan construction, which includes the iterative
K-Means actions, plus a full collect) on ``$BENCH_SF_DIR`` (default sf0.1)
with ``local[$BENCH_CPUS]`` and prints one JSON line:

    {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Cached intermediate results are dropped between queries so every query pays
for its own split / clustering.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "A3_top_items",
    "A1_item_stats",
    "X1_stratified_split",
    "M2_wcss_sweep",
    "R1_predict_ratings",
    "R4_grid_search",
    "R5_recommend_top_n",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    from rankwell.session import get_spark
    from rankwell.plans import modelling, registry

    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    queries = registry.all_queries()
    times = {}
    for name in HEADLINE:
        if only and name not in only:
            continue
        if name not in queries:
            continue
        modelling._memo.clear()
        spark.catalog.clearCache()
        t0 = time.time()
        rows = queries[name](spark, sf_dir).collect()
        times[name] = round(time.time() - t0, 3)
        print(f"{name}: {len(rows)} rows {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
