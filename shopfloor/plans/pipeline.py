"""The dataset graph, bronze to gold, as lazily built DataFrames.

``Lakehouse`` builds every dataset of the pipeline from four landing feeds.
Each attribute is one logical plan that Catalyst optimizes end to end (a
dashboard query over ``gold_facts`` prunes and pushes its filters down to the
landing scans). Two steps run a job while a plan is built: an SCD2 dimension
counts its keys to find the hot ones, and RFM scores look for their cut rows.

``run_batch`` materializes the datasets in dependency order (full refresh,
T6): every table is written to a new run folder and then published, so a
reader never sees a half-written table and downstream stages read the
written table instead of recomputing the lineage.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import datetime, timezone
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_PARAMS, KEYS, Params
from ..operators import quality
from ..session import configure
from ..sources import fixtures
from ..sources.tables import ParquetTables
from . import bronze as bronze_plan
from . import gold as gold_plan
from . import silver as silver_plan


class Lakehouse:
    def __init__(self, spark: SparkSession, feeds: dict[str, Callable[[], DataFrame]],
                 params: Params = DEFAULT_PARAMS, run_ts: datetime | None = None,
                 scd2_scale: dict | None = None):
        self.spark = configure(spark)
        self.feeds = feeds
        self.params = params
        self.run_ts = run_ts or datetime.now(timezone.utc)
        self.scd2_scale = scd2_scale or {}

    @classmethod
    def from_tables(cls, spark: SparkSession, sf_dir: str, params: Params = DEFAULT_PARAMS,
                    **kw) -> "Lakehouse":
        """Feeds derived from the driver's TPC-H-like tables (FIXTURES.md)."""
        raw = ParquetTables(spark, sf_dir)
        # Each feed is built once (DataFrames are immutable plans).
        feeds = {name: functools.cache(lambda f=f: f(raw)) for name, f in fixtures.FEEDS.items()}
        return cls(spark, feeds, params, **kw)

    # --- bronze ------------------------------------------------------------------
    def bronze(self, entity: str) -> DataFrame:
        return bronze_plan.bronze(self.feeds[entity](), entity, self.run_ts)

    @cached_property
    def bronze_sales(self) -> DataFrame:
        return self.bronze("sales")

    @cached_property
    def bronze_customers(self) -> DataFrame:
        return self.bronze("customers")

    @cached_property
    def bronze_products(self) -> DataFrame:
        return self.bronze("products")

    @cached_property
    def bronze_stores(self) -> DataFrame:
        return self.bronze("stores")

    # --- silver --------------------------------------------------------------------
    @cached_property
    def customers_cleansed(self) -> DataFrame:
        return silver_plan.cleansed(self.bronze_customers, "customers")

    @cached_property
    def products_cleansed(self) -> DataFrame:
        return silver_plan.cleansed(self.bronze_products, "products")

    @cached_property
    def stores_cleansed(self) -> DataFrame:
        return silver_plan.cleansed(self.bronze_stores, "stores")

    @cached_property
    def silver_customers(self) -> DataFrame:
        return silver_plan.dimension_history(self.customers_cleansed, "customers", **self.scd2_scale)

    @cached_property
    def silver_products(self) -> DataFrame:
        return silver_plan.dimension_history(self.products_cleansed, "products", **self.scd2_scale)

    @cached_property
    def silver_stores(self) -> DataFrame:
        return silver_plan.dimension_history(self.stores_cleansed, "stores", **self.scd2_scale)

    @cached_property
    def customers_current(self) -> DataFrame:
        return silver_plan.dimension_current(self.silver_customers)

    @cached_property
    def products_current(self) -> DataFrame:
        return silver_plan.dimension_current(self.silver_products)

    @cached_property
    def stores_current(self) -> DataFrame:
        return silver_plan.dimension_current(self.silver_stores)

    @cached_property
    def present_keys(self) -> dict[str, DataFrame]:
        """Key column -> the keys that the referential checks J1-J3 find (a
        null key of a change is left to rule E1, a null key of a sale finds none)."""
        cleansed = {"stores": self.stores_cleansed, "customers": self.customers_cleansed,
                    "products": self.products_cleansed}
        return {KEYS[name]: silver_plan.dimension_keys(body, name) for name, body in cleansed.items()}

    @cached_property
    def sales_cleansed(self) -> DataFrame:
        keys = self.present_keys
        return silver_plan.sales_cleansed(self.bronze_sales, keys["store_id"], keys["customer_id"], keys["product_id"])

    @cached_property
    def silver_sales(self) -> DataFrame:
        return silver_plan.silver_sales(self.sales_cleansed)

    @cached_property
    def silver_returns(self) -> DataFrame:
        return silver_plan.silver_returns(self.sales_cleansed)

    # --- gold --------------------------------------------------------------------------
    @cached_property
    def gold_facts(self) -> DataFrame:
        """G1. The inner joins with the current dimensions drop exactly the
        rows the referential semi joins of C4 drop (same snapshot), so when
        the whole chain runs as one plan the semi joins are left out: three
        fewer joins of the fact table, same rows."""
        unchecked = silver_plan.sales_cleansed(self.bronze_sales, None, None, None)
        sales = silver_plan.silver_sales(unchecked)
        return gold_plan.denormalized(sales, self.customers_current, self.products_current,
                                      self.stores_current)

    @cached_property
    def gold_daily_store(self) -> DataFrame:
        return gold_plan.daily_by_store(self.gold_facts)

    @cached_property
    def gold_product(self) -> DataFrame:
        return gold_plan.product_performance(self.gold_facts)

    @cached_property
    def gold_customer(self) -> DataFrame:
        return gold_plan.customer_lifetime_value(self.gold_facts, self.params.as_of,
                                                 self.params.score_order)

    @cached_property
    def customer_spend(self) -> DataFrame:
        """The rows of G4 without scores: nothing is ranked."""
        return gold_plan.customer_spend(self.gold_facts, self.params.as_of)

    # --- quality -----------------------------------------------------------------------
    def quality_report(self) -> DataFrame:
        """E4 over every rule of the pipeline, each evaluated on its dataset body.

        Datasets that are row subsets of one body share one aggregate, so each
        source is scanned once: the sales feed carries the bronze rule, and,
        on the rows the referential checks keep, the C4 rules, and the fact
        rules on the sales (quantity > 0) and returns (quantity < 0) rows (the
        return body's sign normalisation touches no column a rule reads).
        Customers and products share bronze and cleansed bodies; the stores
        body rewrites ``manager``, so it is counted on its own."""
        flagged = self.feeds["sales"]().select(*bronze_plan.typed("sales"))
        kept = F.lit(True)
        for key, present in self.present_keys.items():
            flagged = flagged.join(present.withColumn(f"_has_{key}", F.lit(True)), key, "left")
            kept = kept & F.col(f"_has_{key}").isNotNull()
        quantity = F.col("quantity")
        parts = [quality.report_many(flagged, [
            ("bronze_sales", bronze_plan.rules("sales"), None),
            ("sales_cleaned", silver_plan.SALES_RULES, kept),
            ("silver_sales", silver_plan.FACT_RULES, kept & (quantity > 0)),
            ("silver_returns", silver_plan.FACT_RULES, kept & (quantity < 0)),
        ])]
        for entity, rules in (("customers", silver_plan.CUSTOMER_RULES), ("products", silver_plan.PRODUCT_RULES)):
            body = self.feeds[entity]().select(*bronze_plan.typed(entity))
            parts.append(quality.report_many(body, [(f"bronze_{entity}", bronze_plan.rules(entity), None),
                                                    (f"{entity}_cleaned", rules, None)]))
        stores = self.feeds["stores"]().select(*bronze_plan.typed("stores"))
        parts += [quality.report(stores, "bronze_stores", bronze_plan.rules("stores")),
                  quality.report(silver_plan.stores_body(stores), "stores_cleaned", silver_plan.STORE_RULES)]
        return quality.union_reports(parts)
