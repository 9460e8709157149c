"""Landing-shaped entity feeds derived from the driver's TPC-H-like tables.

The driver tables hold no NULLs and no orphans, so every defect class the
pipeline must handle (returns, zero quantities, negative discounts, bad
emails, missing managers, orphan keys, out-of-range prices ...) is derived by
a deterministic expression of the keys. The same derivation is written as SQL
for the DuckDB oracle (``oracle/sql.py``); both follow FIXTURES.md section 2.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import ParquetTables


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def _scan(raw: ParquetTables, name: str, *columns: str) -> DataFrame:
    """Columns of a table and the file each row comes from."""
    return raw.table(name).select(*columns, F.col("_metadata.file_path").alias("source_file_path"))


def _days(text: str, days: Column) -> Column:
    return _ts(text) + F.make_dt_interval(days=days.cast("int"))


# Ids from here on name nothing: orphans are made on the fact side.
ORPHAN = 10_000_000

# One word per category family, and two that name none.
PRODUCT_WORDS = ("Shoe", "Belt", "Saree", "Track", "Shirt", "Sweater", "Gown", "Jeans", "Cap")


def sales(raw: ParquetTables) -> DataFrame:
    li = _scan(raw, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
               "l_discount", "l_returnflag", "l_shipdate")
    orders = raw.table("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    # lineitem x orders is the one large fact-to-fact join: both sides are
    # shuffled on the order key (sort-merge) unless orders is measured small.
    b = li.join(orders, li.l_orderkey == orders.o_orderkey, "inner")
    qty_int = F.col("l_quantity").cast("bigint")
    quantity = (
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7), -qty_int)
        .when((F.col("l_linenumber") == 1) & (F.col("l_suppkey") % 25 == 0), F.lit(0))
        .otherwise(qty_int)
    )
    cents = (F.col("l_partkey") * 37) % 20000 + 90000
    b = b.select("*", quantity.alias("quantity"), cents.alias("cents"))
    payment = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "Credit Card")
        .when(F.col("o_orderpriority") == "2-HIGH", "UPI")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "Cash")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Net Banking")
        .otherwise("Cheque")
    )
    rate = F.when(F.col("cents") <= 100000, F.lit(5)).otherwise(F.lit(12))
    # The writer rounds the tax to cents, half away from zero.
    tax = F.call_function("div", F.abs("quantity") * F.col("cents") * rate + 50, F.lit(100)) * F.sign("quantity")
    return b.select(
        F.col("l_orderkey").cast("bigint").alias("transaction_id"),
        F.when(F.col("l_suppkey") % 20 == 9, F.col("l_suppkey") + ORPHAN).otherwise(F.col("l_suppkey"))
        .cast("bigint").alias("store_id"),
        (F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(hours=F.col("l_linenumber")))
        .alias("event_time"),
        F.when(F.col("o_orderkey") % 37 == 5, F.col("o_custkey") + ORPHAN).otherwise(F.col("o_custkey"))
        .cast("bigint").alias("customer_id"),
        F.col("l_partkey").cast("bigint").alias("product_id"),
        F.col("quantity"),
        (F.col("cents").cast("double") / 100).alias("unit_price"),
        ((F.col("quantity") * F.col("cents")).cast("double") / 100).alias("total_amount"),
        payment.alias("payment_method"),
        F.when(F.col("l_partkey") % 50 == 0, -(F.col("l_discount") + F.lit(0.01)))
        .otherwise(F.col("l_discount")).alias("discount_applied"),
        (tax.cast("double") / 100).alias("tax_amount"),
        "source_file_path",
    )


def customers(raw: ParquetTables) -> DataFrame:
    """One to four changes per customer: out of order, with a repeated time,
    NULL updates, and changes of untracked columns only."""
    c = _scan(raw, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal")
    key, v = F.col("c_custkey"), F.col("v")
    c = c.withColumn("v", F.explode(F.sequence(F.lit(0), (key % 4).cast("int"))))
    day = (F.when((key % 11 == 0) & (v == 1), F.lit(0)).when(key % 2 == 1, 3 - v).otherwise(v))
    return c.select(
        key.cast("bigint").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.when((key % 50 == 0) | ((v == 1) & (key % 3 == 0)), F.lit(None).cast("string"))
        .when(key % 50 == 1, F.lit("bad-email"))
        .when(v == 2, F.concat(F.col("c_name"), F.lit(".new@x.io")))
        .otherwise(F.concat(F.col("c_name"), F.lit("@x.io"))).alias("email"),
        F.concat(F.lit("addr "), (F.col("c_nationkey") + F.when(v == 3, F.lit(100)).otherwise(F.lit(0))).cast("string"),
                 F.lit("\nfloor "), (key % 9).cast("string")).alias("address"),
        _ts("1994-06-01 00:00:00").alias("join_date"),
        (F.floor("c_acctbal").cast("bigint") + v * 10).alias("loyalty_points"),
        F.concat(F.lit("p"), key.cast("string")).alias("phone_number"),
        (key % 110).cast("bigint").alias("age"),
        F.when(key % 4 == 0, "Male").when(key % 4 == 1, "Female")
        .when(key % 4 == 2, "Other").otherwise("n/a").alias("gender"),
        _days("1995-01-01 00:00:00", day).alias("last_update_time"),
        "source_file_path",
    )


def products(raw: ParquetTables) -> DataFrame:
    """One to three changes per product; some stock figures do not fit an INT."""
    p = _scan(raw, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    key, v = F.col("p_partkey"), F.col("v")
    p = p.withColumn("v", F.explode(F.sequence(F.lit(0), (key % 3).cast("int"))))
    word = F.array(*[F.lit(w) for w in PRODUCT_WORDS])[(key % len(PRODUCT_WORDS)).cast("int")]
    return p.select(
        key.cast("bigint").alias("product_id"),
        F.concat(F.col("p_name"), F.lit(" "), word).alias("name"),
        F.when(key % 40 == 7, F.lit(None).cast("string")).otherwise(F.col("p_type")).alias("category"),
        F.when((key % 30 == 0) | ((v == 1) & (key % 4 == 1)), F.lit(None).cast("string"))
        .otherwise(F.col("p_brand")).alias("brand"),
        F.when(key % 25 == 3, F.lit(50.0)).when(key % 25 == 4, F.lit(10000.0))
        .otherwise(F.col("p_retailprice") + F.when(v == 2, F.lit(1.0)).otherwise(F.lit(0.0))).alias("price"),
        F.when(key % 23 == 0, F.lit(3_000_000_000)).otherwise(key % 7 - 1 + v).cast("bigint").alias("stock_quantity"),
        F.col("p_size").cast("string").alias("size"),
        F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)).alias("color"),
        F.concat(F.lit("about "), F.col("p_name")).alias("description"),
        _days("1995-01-01 00:00:00", (v * 2) % 3).alias("last_update_time"),
        "source_file_path",
    )


def stores(raw: ParquetTables) -> DataFrame:
    """One to three changes per store; the phone number is untracked."""
    s = _scan(raw, "supplier", "s_suppkey", "s_name", "s_nationkey")
    key, v = F.col("s_suppkey"), F.col("v")
    s = s.withColumn("v", F.explode(F.sequence(F.lit(0), (key % 3).cast("int"))))
    return s.select(
        key.cast("bigint").alias("store_id"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("addr "), F.col("s_nationkey").cast("string")).alias("address"),
        F.when(key % 10 == 3, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("m"), F.col("s_nationkey").cast("string"))).alias("manager"),
        _ts("1994-01-01 00:00:00").alias("open_date"),
        F.when((key + F.floor(v / 2)) % 4 == 0, "Under Renovation").when((key + F.floor(v / 2)) % 4 == 1, "Closed")
        .otherwise("Open").alias("status"),
        F.concat(F.lit("p"), key.cast("string"), F.lit("-"), v.cast("string")).alias("phone_number"),
        _days("1995-01-01 00:00:00", 2 - v).alias("last_update_time"),
        "source_file_path",
    )


def product_grades(raw: ParquetTables) -> DataFrame:
    """A long change feed per product (about 30 rows each): the lines sold,
    by ship time, with repeated times and NULL updates."""
    li = raw.table("lineitem").select("l_partkey", "l_shipdate", "l_linenumber", "l_returnflag", "l_linestatus", "l_quantity")
    return li.select(
        F.col("l_partkey").cast("int").alias("product_id"),
        F.col("l_returnflag").alias("grade"),
        F.when(F.col("l_linenumber") % 3 != 0, F.col("l_linestatus")).alias("state"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(hours=F.col("l_linenumber") % 2)).alias("last_update_time"),
    )


def customer_changes(raw: ParquetTables) -> DataFrame:
    """Out-of-order customer change feed (the events stream): one row per
    event, email NULL on error events so ``ignore_null_updates`` matters."""
    e = raw.table("events").select("user_id", "event_type", "value", "ts")
    return e.select(
        F.col("user_id").cast("int").alias("customer_id"),
        F.concat(F.lit("n"), F.col("user_id").cast("string")).alias("name"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
        .otherwise(F.concat(F.col("event_type"), F.lit("@x.io"))).alias("email"),
        F.floor("value").cast("int").alias("loyalty_points"),
        F.col("ts").cast("timestamp").alias("last_update_time"),
    )


FEEDS = {"sales": sales, "customers": customers, "products": products, "stores": stores}
