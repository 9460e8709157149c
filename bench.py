"""Benchmark: one full pipeline refresh and every dashboard query.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line:

  pipeline_refresh   landing feeds -> bronze -> silver (SCD2) -> gold, stored
  q01..q19           the dashboard queries over the published gold tables
  h4/w4/j8/e4/d1     operator queries over the whole raw tables

``value`` is the sum of all timings (seconds).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shopfloor import config as C  # noqa: E402
from shopfloor.plans import dashboard as D  # noqa: E402
from shopfloor.plans.catalog import QUERIES  # noqa: E402
from shopfloor.plans.pipeline import Lakehouse  # noqa: E402
from shopfloor.plans.refresh import full_refresh  # noqa: E402
from shopfloor.session import build_session  # noqa: E402
from shopfloor.sources.store import RunStore  # noqa: E402

DASHBOARD = [
    ("q01", D.q01_total_revenue, [C.GOLD_FACTS]),
    ("q02", D.q02_total_transactions, [C.GOLD_FACTS]),
    ("q03", D.q03_total_customers, [C.GOLD_FACTS]),
    ("q04", D.q04_avg_order_value, [C.GOLD_FACTS]),
    ("q05", D.q05_daily_revenue, [C.GOLD_DAILY_STORE]),
    ("q06", D.q06_top_stores, [C.GOLD_DAILY_STORE]),
    ("q07", D.q07_top_products, [C.GOLD_FACTS]),
    ("q08", D.q08_revenue_by_category, [C.GOLD_FACTS]),
    ("q09", D.q09_revenue_by_payment, [C.GOLD_FACTS]),
    ("q10", D.q10_category_performance, [C.GOLD_FACTS]),
    ("q11", D.q11_top20_products, [C.GOLD_FACTS]),
    ("q12", D.q12_store_performance, [C.GOLD_DAILY_STORE]),
    ("q13", D.q13_bottom_stores, [C.GOLD_DAILY_STORE]),
    ("q14", D.q14_active_stores, [C.SILVER_STORES, C.GOLD_FACTS]),
    ("q15", D.q15_engagement_top10, [C.GOLD_DAILY_STORE]),
    ("q16", D.q16_rfm_counts, [C.GOLD_CUSTOMER]),
    ("q17", D.q17_rfm_performance, [C.GOLD_CUSTOMER]),
    ("q18", D.q18_acquisition, [C.GOLD_CUSTOMER]),
    ("q19", D.q19_top100_customers, [C.GOLD_CUSTOMER]),
]
FROM_RAW = ["h4_scd2_customer_changes", "h5_scd2_hot_keys", "w4_ntile_orders", "j8_orphans", "e4_quality_report",
            "d1_d2_amount_tax"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session("shopfloor-bench", master=f"local[{cpus}]", shuffle_partitions=2 * cpus,
                          extra={"spark.driver.memory": "16g"})
    scratch = tempfile.mkdtemp(prefix="bench-", dir=os.environ.get("TMPDIR", "/tmp"))
    timings: dict[str, float] = {}

    # Warm-up (JVM, class loading): not timed.
    spark.read.parquet(f"{sf_dir}/region.parquet").count()

    lake = Lakehouse.from_tables(spark, sf_dir)
    t0 = time.perf_counter()
    full_refresh(spark, lake.feeds, f"{scratch}/lake")
    timings["pipeline_refresh"] = time.perf_counter() - t0

    store = RunStore(spark, f"{scratch}/lake").current()
    for name, fn, tables in DASHBOARD:
        t0 = time.perf_counter()
        fn(*[store.read(t) for t in tables], C.DEFAULT_PARAMS).collect()
        timings[name] = time.perf_counter() - t0

    for name in FROM_RAW:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name.split("_")[0]] = time.perf_counter() - t0

    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": {k: round(v, 3) for k, v in timings.items()}, "sf": sf, "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
