"""Benchmark: headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR.

Prints one JSON line: {"metric", "value" (sum of per-query medians, sec),
"unit", "queries": {name: median sec}, "sf", "cpus", "spark", "runs"}.
Each query is run once to warm up, then ``BENCH_RUNS`` times (default 3),
every run computing its full result into the no-op sink.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "clean_orders", "clean_payments", "enrich_orders", "upsert_orders", "upsert_payments",
    "stg_customers", "dim_sellers", "fact_orders", "agg_daily_gmv", "top_sellers",
    "order_status_dist", "delivery_by_state", "kpis", "quality_fact_orders", "model_tests",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = os.environ.get("BENCH_QUERIES")
    names = only.split(",") if only else HEADLINE

    from ordersmith.session import get_session
    import pyspark

    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus))
    spark = get_session(f"local[{cpus}]", app="ordersmith-bench", shuffle_partitions=parts)
    import importlib.util
    spec = importlib.util.spec_from_file_location("spark_entry",
                                                  os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    queries = mod.queries()

    def run(name: str) -> float:
        t0 = time.perf_counter()
        df = queries[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    out = {}
    for name in names:
        run(name)
        out[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_median", "value": round(sum(out.values()), 3),
        "unit": "sec", "queries": out, "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus), "spark": pyspark.__version__, "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
