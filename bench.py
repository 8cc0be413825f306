"""Benchmark: build the warehouse and run the headline queries at one scale.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (optional comma list).  Prints ONE JSON line.

Each query is executed in full with the ``noop`` sink (no driver collect),
so the timing covers the whole plan.  ``build_warehouse`` is the one-off
materialisation of the raw tables and marts that every query reads.  A
trivial warm-up job runs first; its time is reported as ``warmup_sec`` and
is not part of ``value``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from trolley import catalog  # noqa: E402
from trolley.plans.warehouse import Warehouse  # noqa: E402
from trolley.session import local_session  # noqa: E402

HEADLINE = (
    "department_counts", "kpis_observed", "kpis_all", "basket_by_dow", "basket_distribution", "day_hour_heatmap",
    "dept_dow_share", "top_products_in_top_departments", "reorder_rate_extremes", "order_gap_extremes",
    "product_cart_position_extremes", "dim_users", "dim_user_segmented", "segment_summary", "customer_histograms",
    "product_pairs", "top_product_pairs", "association_rules", "pair_matrix", "dq_report", "profile_missing",
    "iqr_outliers", "stream_product_counts",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or list(HEADLINE)
    spark = local_session(cpus, shuffle_partitions=max(8, cpus * 2), app="trolley-bench")
    reg = catalog.registry()
    timings: dict[str, float] = {}

    # warm-up: one trivial shuffle job so JVM/JIT start-up is not charged to the first measured step
    w0 = time.perf_counter()
    spark.range(100_000).groupBy((F.col("id") % 10).alias("k")).count().collect()
    warmup = round(time.perf_counter() - w0, 3)

    t0 = time.perf_counter()
    wh = Warehouse.get(spark, sf_dir)
    wh.build_all(threads=8)
    timings["build_warehouse"] = round(time.perf_counter() - t0, 3)

    for name in names:
        t = time.perf_counter()
        df = reg[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    total = round(sum(timings.values()), 3)
    print(json.dumps({"metric": "warehouse_build_plus_headline_queries", "value": total, "unit": "sec",
                      "queries": timings, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus,
                      "warmup_sec": warmup}))
    spark.stop()


if __name__ == "__main__":
    main()
