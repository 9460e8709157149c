"""Sales that wait for late dimension rows, and catalog tables with comments."""

import inspect
from datetime import datetime

import pytest

from shopfloor import config as C
from shopfloor.plans import dashboard as D
from shopfloor.plans.dashboard_sql import TEXTS
from shopfloor.plans.pipeline import Lakehouse
from shopfloor.plans.refresh import full_refresh
from shopfloor.schemas import BRONZE_TYPES
from shopfloor.sources import fixtures, landing
from shopfloor.sources.store import RunStore, TableStore
from shopfloor.sources.tables import ParquetTables
from shopfloor.sources.versions import VersionedTable
from shopfloor.streaming import ingest, quarantine
from shopfloor.streaming.ingest import bronze_schema, process_sales_batch, read_daily, release_waiting
from shopfloor.streaming.quarantine import Quarantine
from shopfloor.streaming.runner import run_available_now

from tests.conftest import SF_SMALL

DAY = datetime(2024, 1, 5, 10)


def _dimension(spark, store, name, key, ids):
    extra = ["'k' AS category"] if name == C.SILVER_PRODUCTS else []
    store.write(spark.createDataFrame([(i,) for i in ids], f"{key} int").selectExpr(
        key, "'n' AS name", *extra, "CAST(NULL AS TIMESTAMP) AS __END_AT"), name)


@pytest.fixture()
def store(spark, scratch):
    out = TableStore(spark, f"{scratch}/lake")
    for name, key in ((C.SILVER_CUSTOMERS, "customer_id"), (C.SILVER_PRODUCTS, "product_id"), (C.SILVER_STORES, "store_id")):
        _dimension(spark, out, name, key, [1])
    return out


def _sales(spark, rows):
    """(transaction, store, customer, quantity)"""
    schema = ", ".join(f"{n} {t}" for n, t in BRONZE_TYPES["sales"])
    full = [{"transaction_id": i, "store_id": s, "customer_id": c, "product_id": 1, "event_time": DAY, "quantity": q, "unit_price": 2.0,
             "total_amount": 2.0 * q, "payment_method": "Cash", "discount_applied": 0.0, "tax_amount": 0.1} for i, s, c, q in rows]
    values = [tuple(r[n] for n, _ in BRONZE_TYPES["sales"]) for r in full]
    return spark.createDataFrame(values, schema).selectExpr("*", "timestamp '2024-01-01' ingest_timestamp", "'f' source_file_path")


def _ids(store, name=C.GOLD_FACTS):
    return sorted(r.transaction_id for r in store.read(name).collect())


def _waiting(store):
    held = Quarantine(store).waiting(bronze_schema("sales"))
    return sorted(r.transaction_id for r in held.collect()) if held is not None else []


def test_orphans_wait_and_come_in_with_a_later_batch(spark, store):
    process_sales_batch(_sales(spark, [(1, 1, 1, 2), (2, 7, 1, 2), (3, 1, 8, -1), (4, None, 1, 1), (2, 7, 1, 2)]), 0, store)
    assert _ids(store) == [1] and _waiting(store) == [2, 2, 3]
    _dimension(spark, store, C.SILVER_STORES, "store_id", [1, 7])
    process_sales_batch(_sales(spark, [(9, 1, 1, 1)]), 1, store)
    assert _ids(store) == [1, 2, 2, 9] and _waiting(store) == [3]
    _dimension(spark, store, C.SILVER_CUSTOMERS, "customer_id", [1, 8])
    # The batch is retried after the other dimension came: replaced whole, nothing twice.
    process_sales_batch(_sales(spark, [(9, 1, 1, 1)]), 1, store)
    assert _ids(store) == [1, 2, 2, 9] and _ids(store, C.SILVER_RETURNS) == [3] and _waiting(store) == []
    assert [(r.store_id, r.total_transactions) for r in read_daily(store).orderBy("store_id").collect()] == [(1, 2), (7, 2)]
    counted = {(r.dataset, r.rule): r.p for r in store.read(C.QUALITY_METRICS).groupBy("dataset", "rule").sum("passed")
               .withColumnRenamed("sum(passed)", "p").collect()}
    assert counted[("sales_cleaned", "realistic_discount")] == 5 and counted[("silver_returns", "valid_discount")] == 1
    with pytest.raises(ValueError, match="full refresh"):
        process_sales_batch(_sales(spark, [(1, 1, 1, 2)]), 0, store)


def test_release_without_new_sales_survives_a_crash_at_each_step(spark, store, monkeypatch):
    assert release_waiting(store) is False
    process_sales_batch(_sales(spark, [(1, 1, 1, 2), (2, 7, 1, 3)]), 0, store)
    _dimension(spark, store, C.SILVER_STORES, "store_id", [1, 7])
    seen, stop_at = [], [None]

    def step(self, what):
        seen.append(what)
        if stop_at[0] is not None and len(seen) > stop_at[0]:
            raise InterruptedError(what)

    monkeypatch.setattr(VersionedTable, "step", step)
    for at in range(100):
        seen.clear()
        stop_at[0] = at
        try:
            release_waiting(store)
            break
        except InterruptedError:
            stop_at[0] = None
            assert Quarantine(store).releasing() in (None, 1)
    assert at > 3
    stop_at[0] = None
    ingest.end_release(store)
    assert _ids(store) == [1, 2] and _waiting(store) == []
    assert sorted((r.store_id, r.total_items_sold) for r in read_daily(store).collect()) == [(1, 2), (7, 3)]
    process_sales_batch(_sales(spark, [(5, 1, 1, 1)]), 1, store)
    assert _ids(store) == [1, 2, 5] and {r.total_transactions for r in read_daily(store).collect()} == {1, 2}


def test_held_folders_stay_bounded_and_empty_batches_pass(spark, store, monkeypatch):
    monkeypatch.setattr(quarantine, "FAN", 2)
    monkeypatch.setattr(Quarantine, "_changed", staticmethod(lambda held, dimensions: False))
    for i in range(5):
        process_sales_batch(_sales(spark, [(i, 7, 1, 1)] if i != 1 else []), i, store)
        assert len(Quarantine(store).table.manifest().runs["held"]) <= 2
    assert _waiting(store) == [0, 2, 3, 4]


def test_late_stores_end_as_a_full_refresh(spark, scratch):
    lake = Lakehouse.from_tables(spark, SF_SMALL)
    raw, land = ParquetTables(spark, SF_SMALL), f"{scratch}/landing"
    for entity, feed in fixtures.FEEDS.items():
        df = feed(raw)
        landing.append(df.where("store_id % 2 = 0") if entity == "stores" else df, f"{land}/{entity}", entity)
    store = TableStore(spark, f"{scratch}/stream")
    run_available_now(spark, land, store, f"{scratch}/ckpt")
    assert store.read(C.GOLD_FACTS).count() < lake.gold_facts.count()
    landing.append(fixtures.FEEDS["stores"](raw).where("store_id % 2 <> 0"), f"{land}/stores", "stores")
    run_available_now(spark, land, store, f"{scratch}/ckpt")
    got, want = store.read(C.GOLD_FACTS).drop("event_month", "batch_id"), lake.gold_facts
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    daily = lake.gold_daily_store
    rolled = read_daily(store).select(*daily.columns)
    assert rolled.exceptAll(daily).count() == 0 and daily.exceptAll(rolled).count() == 0

    # Catalog tables over the same stream, its dimensions as views.
    made = store.create_tables("streamed")
    assert {"streamed.silver_stores", "streamed.silver_stores_current", "streamed.bronze_sales"} <= set(made)
    for name, df in (("silver_stores", lake.silver_stores), ("silver_stores_current", lake.stores_current)):
        table = spark.table(f"streamed.{name}").select(*df.columns)
        assert table.exceptAll(df).count() == 0 and df.exceptAll(table).count() == 0
    assert spark.table("streamed.bronze_sales").count() == lake.bronze_sales.count()


def test_catalog_tables_carry_comments_and_serve_the_dashboard(spark, scratch):
    lake = Lakehouse.from_tables(spark, SF_SMALL)
    full_refresh(spark, lake.feeds, f"{scratch}/batch")
    stored = RunStore(spark, f"{scratch}/batch").current()
    made = stored.create_tables("lakehouse")
    assert len(made) == len(C.COMMENTS) + 3
    told = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED lakehouse.gold_customer_lifetime_value").collect()}
    assert told["Comment"] == C.COMMENTS[C.GOLD_CUSTOMER] and told["Type"] == "EXTERNAL"
    for view in spark.catalog.listTables():
        if view.isTemporary:
            spark.catalog.dropTempView(view.name)
    spark.catalog.setCurrentDatabase("lakehouse")
    try:
        tables = {"facts": stored.read(C.GOLD_FACTS), "daily": stored.read(C.GOLD_DAILY_STORE), "clv": stored.read(C.GOLD_CUSTOMER),
                  "stores_history": stored.read(C.SILVER_STORES)}
        for name, text in TEXTS.items():
            fn = getattr(D, name)
            want = fn(*[tables[a] for a in inspect.signature(fn).parameters if a != "p"], lake.params)
            assert sorted(map(str, D.run_sql(spark, text, lake.params).collect())) == sorted(map(str, want.collect())), name
    finally:
        spark.catalog.setCurrentDatabase("default")
    # Registered again: tables are replaced, files stay.
    stored.create_tables("lakehouse")
    assert spark.table("lakehouse.gold_denormalized_sales_facts").count() == lake.gold_facts.count()
