"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (no collect to the
driver).  Prints one JSON line:

    {"metric": "total_query_seconds", "value": N, "unit": "sec",
     "queries": {"name": sec, ...}, "sf": "..."}

Set BENCH_QUERIES=name1,name2 to time a subset.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

WARMUP = ("lookup_features", "training_matrix", "resolve_features", "column_profile",
          "download_correlations", "train_forest", "downloads_kmeans", "read_gzip_features")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from trackcast import catalog
    from trackcast.session import build_session

    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                          app_name="trackcast-bench", driver_memory="16g")
    names = only or sorted(catalog.QUERIES)

    # Warm the JVM (class loading, JIT, codegen caches) on the smallest tables,
    # with one query of each kind; not timed.
    smoke = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(smoke):
        for name in WARMUP:
            catalog.QUERIES[name](spark, smoke).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        df = catalog.QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)

    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": sf,
    }))


if __name__ == "__main__":
    main()
