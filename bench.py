"""Benchmark of the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]``. One warm-up pass runs every query once (so the JVM's JIT
and the Python workers are warm for all of them), then each query gets the median of
``$BENCH_RUNS`` (default 2) timed runs. Each run executes the whole plan into
Spark's ``noop`` sink, so no rows pass through the driver. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["comparables", "knn_filtered", "tiered_fallback", "build_corpus", "embed_hashing", "profile_tld",
            "profile_totals", "hard_filter"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE

    from comparo.registry import QUERIES
    from comparo.session import build_session

    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus))
    times: dict[str, float] = {}
    for name in names:  # warm-up pass
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in names:
        fn = QUERIES[name]
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_queries_total_median", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": int(cpus), "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
