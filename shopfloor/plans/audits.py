"""Operator-level queries over the whole tables: orphan audit (J8), scaled
ntile (W4), row rules (D1-D5) and landing key helpers (S12, S13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import KEYS
from ..functions import rules
from ..operators.ranking import ntile_keys
from ..session import configure
from ..sources import fixtures, landing
from ..sources.tables import ParquetTables
from .pipeline import Lakehouse


def j8_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales the referential semi joins discard, tagged with the dimension
    that has no current row for them (a row appears once per dimension).

    One pass over the sales: each dimension's key set (the keys of its checked
    changes; no version is built) is left-joined with a presence flag, and every missing dimension becomes one output row. Equivalent to the union
    of the three anti joins, without scanning the facts three times."""
    lake = Lakehouse.from_tables(spark, sf_dir)
    sales = lake.bronze_sales.drop("ingest_timestamp", "source_file_path")
    out = sales
    flags = []
    for name in ("stores", "customers", "products"):
        key = KEYS[name]
        out = out.join(lake.present_keys[key].withColumn(f"_has_{name}", F.lit(True)), key, "left")
        flags.append(F.when(F.col(f"_has_{name}").isNull(), F.lit(name)))
    missing = F.filter(F.array(*flags), lambda m: m.isNotNull())
    return (out.select(*sales.columns, missing.alias("_missing"))
            .where(F.size("_missing") > 0)
            .select(*sales.columns, F.explode("_missing").alias("missing_dimension")))


def w4_ntile_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NTILE(5) over all orders by price (desc) without a single-task window."""
    configure(spark)
    orders = ParquetTables(spark, sf_dir).table("orders").select("o_orderkey", "o_totalprice")
    return ntile_keys(orders, ["o_orderkey"], 5, {"price_tile": -F.col("o_totalprice")})


def d1_d2_amount_tax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-derive line amount and tax from quantity and unit price and audit
    the stored values against them."""
    configure(spark)
    s = fixtures.sales(ParquetTables(spark, sf_dir))
    amount = rules.line_amount(F.col("quantity"), F.col("unit_price"))
    tax = rules.tax_amount(amount, F.col("unit_price"))
    return s.select("transaction_id", "product_id", "quantity", "unit_price",
                    amount.alias("line_amount"), tax.alias("line_tax"),
                    (amount == F.col("total_amount")).alias("amount_ok"),
                    (tax == F.col("tax_amount")).alias("tax_ok"))


def d3_d4_product_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    p = fixtures.products(ParquetTables(spark, sf_dir))
    return p.select("product_id", "name", rules.name_color(F.col("name")).alias("name_color"),
                    rules.name_size(F.col("name")).alias("name_size"),
                    rules.category_family(F.col("name")).alias("category_family"))


def d5_single_line_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    c = fixtures.customers(ParquetTables(spark, sf_dir))
    return c.select("customer_id", rules.single_line_address(F.col("address")).alias("address"))


def s12_existing_customer_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return landing.existing_keys(fixtures.customers(ParquetTables(spark, sf_dir)), "customer_id")


def s13_next_transaction_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return landing.next_key(fixtures.sales(ParquetTables(spark, sf_dir)), "transaction_id")


QUERIES = {
    "j8_orphans": j8_orphans,
    "w4_ntile_orders": w4_ntile_orders,
    "d1_d2_amount_tax": d1_d2_amount_tax,
    "d3_d4_product_attributes": d3_d4_product_attributes,
    "d5_single_line_address": d5_single_line_address,
    "s12_existing_customer_keys": s12_existing_customer_keys,
    "s13_next_transaction_id": s13_next_transaction_id,
}
