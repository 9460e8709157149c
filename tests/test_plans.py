"""Physical-plan properties the scale design relies on (checked with
``explain``-level plans, not timings)."""

import re
from collections import Counter

import pytest

import __spark_entry__ as E
from shopfloor.config import DEFAULT_PARAMS
from shopfloor.operators.scd2 import scd2
from shopfloor.plans import dashboard as D
from shopfloor.plans.catalog import QUERIES
from shopfloor.plans.refresh import _by_time
from shopfloor.sources import fixtures
from shopfloor.sources.tables import ParquetTables

from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _scans(plan: str) -> Counter:
    return Counter(re.findall(r"/([a-z_]+)\.parquet", plan))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_python_round_robin_or_limit_probe(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas|MapInArrow", plan)
    assert "RoundRobinPartitioning" not in plan and "CartesianProduct" not in plan
    assert not re.search(r"GlobalLimit|LocalLimit", plan)


def test_acquisition_ranks_nothing(spark):
    """q18 reads no score: its plan is one piece, without a stored ranking."""
    plan = _plan(QUERIES["q18_acquisition"](spark, SF_SMALL))
    assert "ExistingRDD" not in plan
    assert plan.lower().count("rangepartitioning") == 1  # the ORDER BY of the result


@pytest.mark.parametrize("name", ["j8_orphans", "g1_denormalized_facts", "c4_sales_cleansed", "q06_top_stores"])
def test_facts_are_scanned_once(spark, name):
    scans = _scans(_plan(E.queries()[name](spark, SF_SMALL)))
    assert scans["lineitem"] == 1 and scans["orders"] == 1


def test_quality_report_scans_the_facts_once(spark):
    scans = _scans(_plan(E.queries()["e4_quality_report"](spark, SF_SMALL)))
    assert scans["lineitem"] == 1 and scans["orders"] == 1


@pytest.mark.parametrize("name", ["j8_orphans", "c4_sales_cleansed", "e4_quality_report"])
def test_referential_checks_build_no_versions(spark, name):
    assert "Window" not in _plan(QUERIES[name](spark, SF_SMALL))


def test_scd2_shuffles_the_change_log_once(spark):
    feed = fixtures.customer_changes(ParquetTables(spark, SF_SMALL))
    plan = _plan(scd2(feed, ["customer_id"], "last_update_time", ["name", "email"], ["last_update_time"]))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "SortMergeJoin" not in plan


def test_scd2_with_hot_keys_reads_the_change_log_once(spark):
    feed = fixtures.product_grades(ParquetTables(spark, SF_SMALL))
    out = scd2(feed, ["product_id"], "last_update_time", ["grade", "state"], ["last_update_time"], hot_rows=12)
    assert out.collect()
    ran = _plan(out).split("Initial Plan")[0]
    assert _scans(ran)["lineitem"] == 1 and "ReusedExchange" in ran


def test_no_bitmap_is_shuffled_or_sorted(spark):
    plan = _plan(QUERIES["a8_store_customers"](spark, SF_SMALL))
    assert "bitmap_construct_agg" in plan and "bitmap_or_agg" in plan
    assert not re.search(r"(Exchange hashpartitioning|Sort \[)[^\n]*\n[^\n]*Aggregate\([^\n]*bitmap_(construct|or)_agg", plan)


@pytest.mark.parametrize("given,planned", [(2, 512), (600, 600)])
def test_tasks_do_not_grow_with_the_tables(spark, given, planned):
    """However few partitions a session names, adaptive execution starts from many and joins small ones."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        spark.conf.set(names[0], str(given))
        plan = _plan(QUERIES["g2_daily_store"](spark, SF_SMALL))
        assert set(re.findall(r"Exchange hashpartitioning\(.*?(\d+)\), ENSURE", plan)) == {str(planned)}
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "32m"
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def test_dashboard_filter_reaches_the_scan(spark, scratch):
    facts = spark.range(10).selectExpr("CAST(id AS INT) AS transaction_id",
                                       "TIMESTAMP '1997-06-01 00:00:00' AS event_time", "1.5D AS total_amount")
    facts.write.parquet(f"{scratch}/facts")
    plan = _plan(D.q01_total_revenue(spark.read.parquet(f"{scratch}/facts"), DEFAULT_PARAMS))
    pushed = plan[plan.index("PushedFilters: ["):]
    assert "IsNotNull(event_time)" in pushed and "GreaterThanOrEqual(event_time" in pushed and "LessThanOrEqual(" in pushed
    assert re.search(r"ReadSchema: struct<event_time:timestamp,total_amount:double>", plan)


def test_partitioned_write_needs_no_range_sampling(spark):
    df = spark.range(100).selectExpr("TIMESTAMP '1997-06-01 00:00:00' + make_dt_interval(id) AS event_time")
    plan = _plan(_by_time(df, "event_time", "event_month"))
    assert "rangepartitioning" not in plan.lower()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
