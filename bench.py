"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores.  Each query
runs once to warm up and then ``BENCH_RUNS`` times (default 1); the best time
counts.  Results are written to Spark's ``noop`` sink, so every row is computed
and none is moved to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "site_shortlist",
    "count_pois_within",
    "distance_edges",
    "attention_aggregate",
    "price_ratio",
    "numeric_summary",
    "categorical_summary",
    "correlation_matrix",
    "impute_median",
    "winsorize",
    "deduplicate",
    "fill_forward_backward",
    "make_sequences",
    "seasonal_decompose",
    "rank_min",
    "knn_join",
    "preprocess_bookings",
    "create_features",
]
#: Timed as well, but outside the total: fits of the models.
APART = ["fit_demand_model", "grid_search"]


def main() -> None:
    from sitecast.catalog.load import QUERIES
    from sitecast.session import local_session

    cpus = os.environ.get("BENCH_CPUS", "8")
    os.environ.setdefault("SITECAST_PARTITIONS", cpus)
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE + APART:
        best = float("inf")
        for i in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            if i:
                best = min(best, took)
        times[name] = round(best, 3)
        print(f"{name} {best:.2f}s", file=sys.stderr, flush=True)
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(times[n] for n in HEADLINE), 3),
        "unit": "sec",
        "queries": {n: times[n] for n in HEADLINE},
        "apart": {n: times[n] for n in APART},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
