"""Registry of every runnable query: name -> (spark, sf_dir) -> DataFrame.

Each entry builds the pipeline from the driver's tables (``Lakehouse.
from_tables``) and returns one dataset or dashboard query over the whole
tables. Names are the SURVEY IDs plus a word.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_PARAMS, SCD2_EXCEPT
from ..operators import scd2
from ..sources import fixtures
from ..sources.tables import ParquetTables
from ..streaming.daily_state import store_customers
from ..session import configure
from . import dashboard as q
from . import audits
from .pipeline import Lakehouse

QueryFn = Callable[[SparkSession, str], DataFrame]


# The ingest time of the registered queries.
RUN_TS = datetime(2002, 1, 1, tzinfo=timezone.utc)


def _lake(spark: SparkSession, sf_dir: str) -> Lakehouse:
    return Lakehouse.from_tables(spark, sf_dir, DEFAULT_PARAMS, run_ts=RUN_TS)


def table_file(df: DataFrame) -> DataFrame:
    """The lineage path reduced to its table's file: the folder is the caller's."""
    if "source_file_path" not in df.columns:
        return df
    return df.withColumn("source_file_path", F.regexp_extract("source_file_path", r"([^/]+\.parquet)(/[^/]*)?$", 1))


def _dataset(attr: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return table_file(getattr(_lake(spark, sf_dir), attr))
    return run


def _dash(fn, *attrs: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        lake = _lake(spark, sf_dir)
        return fn(*[getattr(lake, a) for a in attrs], lake.params)
    return run


def _customer_changes_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    feed = fixtures.customer_changes(ParquetTables(spark, sf_dir))
    return scd2.scd2(feed, ["customer_id"], "last_update_time", ["name", "email"], SCD2_EXCEPT)


def _product_grades_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every product has a long history here: with 12 rows a chunk nearly all
    keys are hot and cut in several chunks."""
    configure(spark)
    feed = fixtures.product_grades(ParquetTables(spark, sf_dir))
    return scd2.scd2(feed, ["product_id"], "last_update_time", ["grade", "state"], SCD2_EXCEPT, hot_rows=12)


def _customer_changes_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.current(_customer_changes_history(spark, sf_dir))


def _store_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark, sf_dir)
    lo, hi = q.date_bounds(lake.params)
    return store_customers(lake.gold_facts, lo.isoformat(), hi.isoformat())


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lake(spark, sf_dir).quality_report()


QUERIES: dict[str, QueryFn] = {
    "b1_bronze_sales": _dataset("bronze_sales"),
    "b2_bronze_customers": _dataset("bronze_customers"),
    "b3_bronze_products": _dataset("bronze_products"),
    "b4_bronze_stores": _dataset("bronze_stores"),
    "c1_customers_cleansed": _dataset("customers_cleansed"),
    "c2_products_cleansed": _dataset("products_cleansed"),
    "c3_stores_cleansed": _dataset("stores_cleansed"),
    "c4_sales_cleansed": _dataset("sales_cleansed"),
    "h1_scd2_customers": _dataset("silver_customers"),
    "h2_scd2_products": _dataset("silver_products"),
    "h3_scd2_stores": _dataset("silver_stores"),
    "h4_scd2_customer_changes": _customer_changes_history,
    "h5_scd2_hot_keys": _product_grades_history,
    "v1_customers_current": _dataset("customers_current"),
    "v2_products_current": _dataset("products_current"),
    "v3_stores_current": _dataset("stores_current"),
    "v4_customer_changes_current": _customer_changes_current,
    "k1_silver_sales": _dataset("silver_sales"),
    "k2_silver_returns": _dataset("silver_returns"),
    "g1_denormalized_facts": _dataset("gold_facts"),
    "g2_daily_store": _dataset("gold_daily_store"),
    "g3_product_performance": _dataset("gold_product"),
    "g4_customer_lifetime_value": _dataset("gold_customer"),
    "e4_quality_report": _quality,
    "a8_store_customers": _store_customers,
    "q01_total_revenue": _dash(q.q01_total_revenue, "gold_facts"),
    "q02_total_transactions": _dash(q.q02_total_transactions, "gold_facts"),
    "q03_total_customers": _dash(q.q03_total_customers, "gold_facts"),
    "q04_avg_order_value": _dash(q.q04_avg_order_value, "gold_facts"),
    "q05_daily_revenue": _dash(q.q05_daily_revenue, "gold_daily_store"),
    "q06_top_stores": _dash(q.q06_top_stores, "gold_daily_store"),
    "q07_top_products": _dash(q.q07_top_products, "gold_facts"),
    "q08_revenue_by_category": _dash(q.q08_revenue_by_category, "gold_facts"),
    "q09_revenue_by_payment": _dash(q.q09_revenue_by_payment, "gold_facts"),
    "q10_category_performance": _dash(q.q10_category_performance, "gold_facts"),
    "q11_top20_products": _dash(q.q11_top20_products, "gold_facts"),
    "q12_store_performance": _dash(q.q12_store_performance, "gold_daily_store"),
    "q13_bottom_stores": _dash(q.q13_bottom_stores, "gold_daily_store"),
    "q14_active_stores": _dash(q.q14_active_stores, "silver_stores", "gold_facts"),
    "q15_engagement_top10": _dash(q.q15_engagement_top10, "gold_daily_store"),
    "q16_rfm_counts": _dash(q.q16_rfm_counts, "gold_customer"),
    "q17_rfm_performance": _dash(q.q17_rfm_performance, "gold_customer"),
    "q18_acquisition": _dash(q.q18_acquisition, "customer_spend"),
    "q19_top100_customers": _dash(q.q19_top100_customers, "gold_customer"),
}
QUERIES.update(audits.QUERIES)
