"""Stored pipeline run, bronze to gold (T6 full refresh, S7, S14, E3 metrics).

Each stage reads the tables the previous stage wrote, so lineage is cut at
every layer (a lost executor recomputes one stage, not the whole chain). The
fact counters are collected with the write that produced them. Tables that do
not read each other are written at the same time.

Facts are stored with a month partition column so date-range queries prune
folders, and row groups are sorted by time for min/max skipping inside a
month. Before the write they are rebalanced on the month (``REBALANCE``
hint): a hash shuffle whose oversized partitions adaptive execution splits
(a month holding a third of the rows becomes many tasks, each writing its own
file) and whose small ones it coalesces, so files stay few and tasks even.
Unlike a range repartition it needs no sampling pass, which would evaluate
the whole upstream plan (scans and joins) a second time.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import quality, scd2
from ..session import checkpoint_dir, configure
from ..sources.store import RunStore, TableStore
from ..sources.tables import local_rows
from . import bronze as bronze_plan
from . import gold as gold_plan
from . import silver as silver_plan

FACT_PARTITION = "event_month"
DAILY_PARTITION = "sale_month"


def _by_time(df: DataFrame, ts_col: str, part_col: str) -> DataFrame:
    return (df.withColumn(part_col, F.trunc(F.col(ts_col).cast("date"), "month"))
            .hint("rebalance", part_col)
            .sortWithinPartitions(part_col, ts_col))


def _observed(body: DataFrame, name: str, rules, metrics: dict) -> DataFrame:
    """Count every rule on the dataset body (filled by the write), then apply
    the row effect of the rules."""
    observed, obs = quality.observed(body, name, rules)
    metrics[name] = (obs, rules)
    return quality.enforce(observed, rules)


def _together(*writes) -> None:
    """Run independent writes from threads of the driver: their jobs share the
    cluster, and one table's tail does not hold up the next."""
    with ThreadPoolExecutor(len(writes)) as pool:
        for done in [pool.submit(w) for w in writes]:
            done.result()


def run_batch(spark: SparkSession, feeds: dict, store: TableStore, params: C.Params = C.DEFAULT_PARAMS,
              run_ts: datetime | None = None, scd2_scale: dict | None = None) -> dict:
    """Materialize every dataset in dependency order, independent ones
    together; returns the expectation counters per dataset."""
    configure(spark)
    checkpoint_dir(spark)
    run_ts = run_ts or datetime.now(timezone.utc)
    scale = scd2_scale or {}
    metrics: dict = {}
    bronze_names = {"sales": C.BRONZE_SALES, "customers": C.BRONZE_CUSTOMERS,
                    "products": C.BRONZE_PRODUCTS, "stores": C.BRONZE_STORES}
    silver_names = {"customers": C.SILVER_CUSTOMERS, "products": C.SILVER_PRODUCTS, "stores": C.SILVER_STORES}

    def bronze(entity: str) -> None:
        store.write(bronze_plan.bronze(feeds[entity](), entity, run_ts), bronze_names[entity])

    def dimension(entity: str) -> None:
        bronze(entity)
        body = silver_plan.BODIES[entity](store.read(bronze_names[entity]))
        # The body is counted in a plan of its own: the history reads it more than once.
        metrics[f"{entity}_cleaned"] = quality.report(
            body, f"{entity}_cleaned", silver_plan.CLEANSE_RULES[entity]).collect()
        cleansed = quality.enforce(body, silver_plan.CLEANSE_RULES[entity])
        store.write(silver_plan.dimension_history(cleansed, entity, **scale), silver_names[entity])

    _together(lambda: bronze("sales"), *[lambda e=e: dimension(e) for e in silver_names])
    current = {e: scd2.current(store.read(n)) for e, n in silver_names.items()}
    sales = store.read(C.BRONZE_SALES)

    # The sales meet the dimensions once: the inner joins keep what the referential
    # checks keep and bring the names along. K1, K2 and G1 read the stored result.
    observations: dict = {}
    named = gold_plan.with_names(silver_plan.sales_body(sales, None, None, None), current["customers"],
                                 current["products"], current["stores"])
    store.write(_observed(named, "sales_cleaned", silver_plan.SALES_RULES, observations), C.CHECKED_SALES)
    checked = store.read(C.CHECKED_SALES)
    unnamed = checked.drop(*gold_plan.DIMENSION_NAMES)
    facts = silver_plan.silver_sales(checked).select(*gold_plan.FACT_COLUMNS)
    _together(
        lambda: store.write(_by_time(facts, "event_time", FACT_PARTITION), C.GOLD_FACTS, partition_by=[FACT_PARTITION]),
        lambda: store.write(_observed(silver_plan.sales_body_k1(unnamed), "silver_sales", silver_plan.FACT_RULES,
                                      observations), C.SILVER_SALES),
        lambda: store.write(_observed(silver_plan.returns_body_k2(unnamed), "silver_returns", silver_plan.FACT_RULES,
                                      observations), C.SILVER_RETURNS))
    store.drop(C.CHECKED_SALES)  # nothing reads it any more

    stored_facts = store.read(C.GOLD_FACTS).drop(FACT_PARTITION)
    daily = gold_plan.daily_by_store(stored_facts)
    _together(
        lambda: store.write(_by_time(daily, "sale_date", DAILY_PARTITION), C.GOLD_DAILY_STORE,
                            partition_by=[DAILY_PARTITION]),
        lambda: store.write(gold_plan.product_performance(stored_facts), C.GOLD_PRODUCT),
        lambda: store.write(gold_plan.customer_lifetime_value(stored_facts, params.as_of, params.score_order),
                            C.GOLD_CUSTOMER))
    # E3 counters of this update (one row per rule) next to the tables: one
    # small file, since the run folder already scopes them (streams partition
    # theirs by dataset and batch for idempotent retries).
    rows = [tuple(r) for found in metrics.values() for r in found]
    counts = {name: {"rows": found[0].passed + found[0].failed, **{r.rule: r.failed for r in found}}
              for name, found in metrics.items()}
    for name, (obs, rules) in observations.items():
        counts[name] = dict(obs.get)
        rows += quality.metrics_rows(name, rules, counts[name])
    report = local_rows(spark, rows, quality.REPORT_FIELDS).withColumn("batch_id", F.lit(0).cast("bigint"))
    store.write(report.coalesce(1), C.QUALITY_METRICS)
    return counts


def full_refresh(spark: SparkSession, feeds: dict, root: str, **kw) -> tuple[str, dict]:
    """Recompute everything into a new run folder, then publish it."""
    runs = RunStore(spark, root)
    run_id = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:6]
    metrics = run_batch(spark, feeds, runs.run(run_id), **kw)
    runs.publish(run_id)
    return run_id, metrics
