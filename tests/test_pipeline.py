"""Pipeline properties over the driver tables and the
stored / streaming runs agreeing with the in-memory plan."""

import inspect
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shopfloor import config as C
from shopfloor.functions.money import money_sum
from shopfloor.plans import bronze, silver
from shopfloor.plans import dashboard as D
from shopfloor.plans.dashboard_sql import TEXTS
from shopfloor.plans.pipeline import Lakehouse
from shopfloor.plans.refresh import full_refresh
from shopfloor.schemas import BRONZE_TYPES
from shopfloor.sources import fixtures, landing
from shopfloor.sources.store import RunStore, TableStore
from shopfloor.sources.tables import ParquetTables
from shopfloor.streaming.ingest import process_sales_batch, read_daily
from shopfloor.streaming.runner import run_available_now

from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def lake(spark):
    return Lakehouse.from_tables(spark, SF_SMALL)


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_fact_split_conserves_rows(lake):
    clean = lake.sales_cleansed
    total = clean.count()
    pos = clean.where("quantity > 0").count()
    neg = clean.where("quantity < 0").count()
    rest = clean.where("quantity = 0 OR quantity IS NULL").count()
    assert pos + neg + rest == total and rest > 0
    dropped_k1 = clean.where("quantity > 0").count() - lake.silver_sales.count()
    dropped_k2 = neg - lake.silver_returns.count()
    assert lake.silver_sales.count() + lake.silver_returns.count() + rest + dropped_k1 + dropped_k2 == total


def test_semi_joins_plus_orphans_is_bronze(lake):
    from shopfloor.operators import joins
    raw = lake.bronze_sales
    kept = silver.sales_body(raw, lake.stores_current, lake.customers_current, lake.products_current)
    s = lake.stores_current
    c = lake.customers_current
    p = lake.products_current
    orphan = (joins.orphans(raw, s, ["store_id"])
              .unionByName(joins.orphans(joins.semi_join(raw, s, ["store_id"]), c, ["customer_id"]))
              .unionByName(joins.orphans(joins.semi_join(joins.semi_join(raw, s, ["store_id"]), c,
                                                         ["customer_id"]), p, ["product_id"])))
    assert kept.count() + orphan.count() == raw.count()


def test_gold_totals_agree(lake):
    g1 = lake.gold_facts.agg(money_sum("total_amount")).first()[0]
    g2 = lake.gold_daily_store.agg(money_sum("total_revenue")).first()[0]
    g3 = lake.gold_product.agg(money_sum("total_revenue")).first()[0]
    assert g1 == g2 == g3
    assert lake.gold_facts.count() == lake.silver_sales.count()


def test_one_current_row_per_key(lake):
    for df, key in ((lake.customers_current, "customer_id"), (lake.products_current, "product_id"),
                    (lake.stores_current, "store_id")):
        assert df.count() == df.select(key).distinct().count()


def test_rfm_tiles_differ_by_at_most_one(lake):
    clv = lake.gold_customer
    for col in ("r_score", "f_score", "m_score"):
        sizes = [r[1] for r in clv.groupBy(col).count().collect()]
        assert max(sizes) - min(sizes) <= 1


def test_quality_report_counts_every_rule(lake):
    rep = lake.quality_report()
    assert rep.count() == 27
    assert rep.where("passed < 0 OR failed < 0").count() == 0


def test_null_key_fails_the_bronze_load(spark):
    cols = ", ".join(f"{n} {t}" for n, t in BRONZE_TYPES["sales"])
    feed = spark.createDataFrame([tuple([None] * len(BRONZE_TYPES["sales"]))], cols)
    with pytest.raises(Exception, match="valid_transaction_id"):
        bronze.bronze(feed, "sales").collect()


def test_stored_refresh_and_streaming_match_in_memory(spark, scratch, lake):
    run_id, metrics = full_refresh(spark, lake.feeds, f"{scratch}/batch")
    stored = RunStore(spark, f"{scratch}/batch").current()
    assert _same(stored.read(C.GOLD_FACTS).drop("event_month"), lake.gold_facts)
    assert _same(stored.read(C.GOLD_CUSTOMER), lake.gold_customer)
    assert metrics["customers_cleaned"]["rows"] == lake.bronze_customers.count()

    # Registered views (S9, S14, S15): every dataset, the current views, comments.
    views = stored.register()
    assert {"gold_daily_sales_by_store", "silver_stores_current", "expectations"} <= set(views)
    assert spark.table("silver_customers_current").count() == lake.customers_current.count()
    assert stored.comment("gold_customer_lifetime_value") == C.COMMENTS[C.GOLD_CUSTOMER]
    # All 19 dashboard texts equal the DataFrame results over the same tables.
    gold = {"facts": stored.read(C.GOLD_FACTS), "daily": stored.read(C.GOLD_DAILY_STORE), "clv": stored.read(C.GOLD_CUSTOMER),
            "stores_history": stored.read(C.SILVER_STORES)}
    assert len(TEXTS) == 19
    for name, text in TEXTS.items():
        fn = getattr(D, name)
        tables = [gold[a] for a in inspect.signature(fn).parameters if a != "p"]
        want, got = fn(*tables, lake.params), D.run_sql(spark, text, lake.params)
        assert got.columns == want.columns, name
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name

    # Streaming: every feed landed in three slices, processed in small triggers.
    raw = ParquetTables(spark, SF_SMALL)
    for entity, feed in fixtures.FEEDS.items():
        df = feed(raw)
        for i in range(3):
            part = df.where(F.pmod(F.xxhash64(*df.columns), F.lit(3)) == i)
            landing.append(part, f"{scratch}/landing/{entity}", entity)
    store = TableStore(spark, f"{scratch}/stream")
    run_available_now(spark, f"{scratch}/landing", store, f"{scratch}/ckpt", max_files_per_trigger=4)
    assert _same(store.read(C.GOLD_FACTS).drop("event_month", "batch_id"), lake.gold_facts)
    daily = lake.gold_daily_store
    assert _same(read_daily(store).select(*daily.columns), daily)
    assert _same(store.read(C.SILVER_CUSTOMERS).drop("_bucket"), lake.silver_customers)
    lineage = store.read(C.BRONZE_SALES).select("source_file_path", "ingest_timestamp")
    assert lineage.where("source_file_path IS NULL OR ingest_timestamp IS NULL").count() == 0

    # Expectation counters: summed over micro-batches, and from the refresh,
    # they equal the one-pass quality report.
    report = {(r.dataset, r.rule): (r.passed, r.failed) for r in lake.quality_report().collect()}

    def counters(table_store):
        agg = (table_store.read(C.QUALITY_METRICS).groupBy("dataset", "rule")
               .agg(F.sum("passed").alias("p"), F.sum("failed").alias("f")).collect())
        return {(r.dataset, r.rule): (r.p, r.f) for r in agg}

    streamed, refreshed = counters(store), counters(stored)
    assert {d for d, _ in streamed} == {"customers_cleaned", "products_cleaned", "stores_cleaned",
                                        "sales_cleaned", "silver_sales", "silver_returns"}
    assert all(report[k] == v for k, v in streamed.items())
    assert all(report[k] == v for k, v in refreshed.items()) and len(refreshed) == len(streamed)

    # A second run with nothing new changes nothing (exactly once).
    before = store.read(C.GOLD_FACTS).count()
    run_available_now(spark, f"{scratch}/landing", store, f"{scratch}/ckpt", max_files_per_trigger=4)
    assert store.read(C.GOLD_FACTS).count() == before


def test_late_row_is_kept_by_the_watermark(spark, scratch):
    """No stateful operator follows the watermark, so a row a year late stays."""
    src = f"{scratch}/sales"
    now = datetime(2024, 6, 1, 12)
    schema = "transaction_id int, event_time timestamp, quantity int"
    spark.createDataFrame([(1, now, 1)], schema).write.parquet(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    body = stream.withColumn("date", F.col("event_time").cast("date")).withWatermark("event_time", C.WATERMARK)
    out, ckpt = f"{scratch}/out", f"{scratch}/ckpt"

    def run():
        (body.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start().awaitTermination())

    run()
    spark.createDataFrame([(2, now - timedelta(days=365), 1)], schema).write.mode("append").parquet(src)
    run()
    assert sorted(r[0] for r in spark.read.parquet(out).select("transaction_id").collect()) == [1, 2]


@pytest.fixture()
def dimensions(spark, scratch):
    """A store with one row of each current dimension."""
    store = TableStore(spark, f"{scratch}/lake")
    for name, cols in ((C.SILVER_CUSTOMERS, "1 customer_id, 'c' name"), (C.SILVER_PRODUCTS, "1 product_id, 'p' name, 'k' category"),
                       (C.SILVER_STORES, "1 store_id, 's' name")):
        store.write(spark.sql(f"SELECT {cols}, CAST(NULL AS TIMESTAMP) __END_AT"), name)
    return store


def _sales(spark, rows):
    schema = ", ".join(f"{n} {t}" for n, t in BRONZE_TYPES["sales"])
    full = [(i, 1, when, 1, 1, qty, 2.0, 2.0 * qty, "Cash", discount, 0.1) for i, when, qty, discount in rows]
    return spark.createDataFrame(full, schema).selectExpr("*", "timestamp '2024-01-01' ingest_timestamp", "'f' source_file_path")


def test_retry_with_fewer_rows_or_none_leaves_nothing_behind(spark, dimensions):
    store = dimensions
    jan, feb = datetime(2024, 1, 5, 10), datetime(2024, 2, 6, 10)
    process_sales_batch(_sales(spark, [(1, jan, 2, 0.0), (2, feb, 3, 0.0), (3, feb, -1, 0.0)]), 0, store)
    process_sales_batch(_sales(spark, [(9, feb, 1, 0.0)]), 1, store)
    assert store.read(C.GOLD_FACTS).count() == 3 and read_daily(store).count() == 2
    process_sales_batch(_sales(spark, [(1, jan, 2, 0.0), (2, feb, 3, -1.0)]), 0, store)
    assert sorted(r.transaction_id for r in store.read(C.GOLD_FACTS).collect()) == [1, 9]
    assert store.read(C.SILVER_RETURNS).count() == 0 and store.read(C.SILVER_SALES).count() == 2
    assert {(str(r.sale_date), r.total_transactions) for r in read_daily(store).collect()} == {("2024-01-05", 1), ("2024-02-06", 1)}
    process_sales_batch(_sales(spark, [(1, jan, 0, 0.0)]), 0, store)
    assert [r.transaction_id for r in store.read(C.GOLD_FACTS).collect()] == [9]
    assert {str(r.sale_date) for r in read_daily(store).collect()} == {"2024-02-06"}


def test_a_sale_without_a_time_does_not_stop_the_stream(spark, dimensions):
    process_sales_batch(_sales(spark, [(1, None, 2, 0.0), (2, datetime(2024, 2, 6), 1, 0.0)]), 0, dimensions)
    assert dimensions.read(C.GOLD_FACTS).count() == 2 and read_daily(dimensions).count() == 1


def test_another_bucket_count_is_refused(spark, scratch):
    from shopfloor.streaming.scd2_stream import apply_changes
    store = TableStore(spark, f"{scratch}/s")
    changes = spark.range(20).selectExpr("id AS k", "concat('n', id) AS name", "id AS seq")
    args = (store, "silver.log", "silver.dim", ["k"], "seq", ["name"], ["seq"])
    apply_changes(changes, 0, *args, buckets=4)
    with pytest.raises(ValueError, match="4 buckets"):
        apply_changes(changes, 1, *args, buckets=16)
    apply_changes(changes.selectExpr("k", "'x' AS name", "seq + 100 AS seq"), 1, *args, buckets=4)
    assert store.read("silver.dim").where("__END_AT IS NULL").count() == 20


def test_publish_adds_a_pointer_and_the_newest_wins(spark, scratch):
    runs = RunStore(spark, f"{scratch}/runs")
    runs.publish("20240101T000000-aaa")
    runs.publish("20240102T000000-bbb")
    assert runs.current().root.endswith("20240102T000000-bbb")


def test_a_run_that_finishes_last_is_current(spark, scratch):
    runs = RunStore(spark, f"{scratch}/runs")
    runs.publish("20240102T000000-bbb")
    runs.publish("20240101T000000-aaa")
    assert runs.current().root.endswith("20240101T000000-aaa")


def test_amounts_below_a_cent_are_rounded_once_in_sql_text_too(spark):
    """100 x 0.125 is 12.5 on both paths, and ratios are rounded half-up."""
    from shopfloor.config import DEFAULT_PARAMS
    when = DEFAULT_PARAMS.date_min.isoformat(sep=" ")
    facts = spark.range(100).selectExpr("id AS transaction_id", f"TIMESTAMP '{when}' AS event_time", "0.125D AS total_amount", "'p' AS product_name",
                                        "IF(id < 97, 'a', 'b') AS product_category", "1 AS product_id", "IF(id < 97, 1, -7) AS quantity", "'Cash' AS payment_method")
    facts.createOrReplaceTempView("gold_denormalized_sales_facts")
    for name in ("q01_total_revenue", "q04_avg_order_value", "q07_top_products", "q08_revenue_by_category", "q09_revenue_by_payment", "q10_category_performance"):
        got, want = D.run_sql(spark, TEXTS[name], DEFAULT_PARAMS), getattr(D, name)(facts, DEFAULT_PARAMS)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name
    assert D.run_sql(spark, TEXTS["q01_total_revenue"], DEFAULT_PARAMS).first()[0] == 12.5
