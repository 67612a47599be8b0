"""Benchmark: headline queries and the full / incremental build.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1).  Each query is executed to completion with the
``noop`` sink (the whole plan runs, nothing is collected): one warm-up, then
the median of ``$BENCH_REPEATS`` (default 3) timed runs.  The build is timed
as a full build into a fresh warehouse, then an incremental rerun.

Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

HEADLINE = (
    "stg_order_items",
    "int_orders_enriched",
    "int_customer_lifetime_metrics",
    "fct_orders",
    "fct_order_items",
    "revenue_ledger",
    "customer_ltv",
    "session_funnel",
    "test_relationships",
    "test_no_orphaned_order_items",
    "dq_summary",
    "source_freshness",
    "metric_revenue_by_country",
    "time_spine",
    "fct_orders_incremental",
    "fct_order_items_incremental",
    "snap_customers_deletes",
    "snap_products_changes",
)


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    from tidemart.plans.build import BuildConfig, build_testdata
    from tidemart.plans.catalog import QUERIES
    from tidemart.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else list(HEADLINE)
    conf = {
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
        "spark.sql.shuffle.partitions": str(max(8, 2 * cpus)),
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tidemart-bench-shared-"),
    }
    spark = build_session(f"local[{cpus}]", "tidemart-bench", extra_conf=conf)

    for name in names[:5]:  # the JVM compiles the common code before anything is timed
        _run(QUERIES[name](spark, sf_dir))

    times: dict[str, float] = {}
    for name in names:
        q = QUERIES[name]
        _run(q(spark, sf_dir))  # warm-up
        runs = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            _run(q(spark, sf_dir))
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)

    wh = tempfile.mkdtemp(prefix="tidemart-bench-wh-")
    cfg = BuildConfig(warehouse=wh, fact_grain="month", run_log=True, run_tests=True, run_snapshots=True)
    steps: dict[str, dict] = {}
    for label in ("build_full", "build_incremental"):
        step_times: dict = {}
        t0 = time.perf_counter()
        build_testdata(spark, sf_dir, cfg, timings=step_times)
        times[label] = round(time.perf_counter() - t0, 3)
        steps[label] = step_times

    sf = Path(sf_dir).name.replace("sf", "")
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(v for k, v in times.items() if not k.startswith("build_")), 3),
        "unit": "sec",
        "queries": times,
        "build_steps": steps,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeats": repeats,
        "spark_conf": {k: spark.conf.get(k) for k in (
            "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled",
            "spark.sql.adaptive.skewJoin.enabled", "spark.sql.autoBroadcastJoinThreshold",
        )},
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
