"""Streaming ingestion: landing -> bronze -> silver facts -> gold facts
(S1, S3, S6, S10, S11, T1, T3, T6, T7).

* Bronze: an incremental file scan of each landing folder, typed and tagged
  with lineage, written by an exactly-once parquet file sink (checkpointed).
* Facts: ``foreachBatch`` over new bronze sales. Each micro-batch is checked
  and enriched against the dimension snapshot read when the batch runs (a
  static side is listed when the DataFrame is built, so it is re-read per
  batch). Each batch has a folder of its own, ``batch_id=N``, replaced whole by
  a retry, so rows that no longer qualify do not stay behind. Facts already
  written are not rewritten when a dimension changes later; a full refresh
  does that.
* Sales whose store, customer or product is not there yet are held and taken up
  when it is (``quarantine``), so a late dimension row costs no sale.
* Expectation counters (E3) are observed by the writes; no aggregate runs for them.
* Daily rollup (T7): streaming COUNT(DISTINCT) is not supported; each batch
  adds its sums and customer bitmaps to a stored state and replaces the days it
  touched in the rollup (``daily_state``).

The watermark (T1) is declared on the sales stream as published; no stateful
operator follows it, so it drops nothing (late rows are kept).
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import config as C
from ..operators import quality, scd2
from ..plans import bronze as bronze_plan
from ..plans import gold as gold_plan
from ..plans import silver as silver_plan
from ..plans.refresh import FACT_PARTITION
from ..schemas import BRONZE_TYPES, struct
from ..sources import landing, scd2_table
from ..sources.store import TableStore
from ..sources.tables import local_rows
from .daily_state import DailyState
from .quarantine import Quarantine, flagged

BRONZE_NAMES = {"sales": C.BRONZE_SALES, "customers": C.BRONZE_CUSTOMERS, "products": C.BRONZE_PRODUCTS,
                "stores": C.BRONZE_STORES}
DIM_NAMES = {"customers": C.SILVER_CUSTOMERS, "products": C.SILVER_PRODUCTS, "stores": C.SILVER_STORES}


def bronze_schema(entity: str):
    return struct(BRONZE_TYPES[entity] + [("ingest_timestamp", "timestamp"), ("source_file_path", "string")])


def bronze_stream(spark: SparkSession, landing_path: str, entity: str, run_ts: datetime,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """S1 + S10 + S11 + P1-P4 + E1 on a stream."""
    src = landing.read_stream(spark, landing_path, entity, max_files_per_trigger)
    return bronze_plan.bronze(src, entity, run_ts)


def read_table_stream(spark: SparkSession, store: TableStore, name: str, entity: str,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """S3: incremental read of a pipeline table written by a file sink."""
    reader = spark.readStream.schema(bronze_schema(entity)).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(store.path(name))


def append_table(stream: DataFrame, store: TableStore, name: str, checkpoint: str,
                 available_now: bool = True) -> StreamingQuery:
    """Append-only, exactly-once parquet sink."""
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="15 seconds")
    return writer.start(store.path(name))


def current_dimension(store: TableStore, name: str) -> DataFrame:
    """V1-V3 over a stored SCD2 table: of a streamed one only the open parts are read."""
    table = store.versioned(name)
    return scd2_table.open_versions(table) if table.exists() else scd2.current(store.read(name))


def process_sales_batch(batch: DataFrame, batch_id: int, store: TableStore) -> None:
    """T3 body: one micro-batch of bronze sales to silver sales/returns and
    gold facts, idempotent per ``batch_id``; then T7 for the touched days."""
    end_release(store)
    _absorb_sales(batch, batch_id, store)


def release_waiting(store: TableStore) -> bool:
    """Take up held sales whose dimension rows have come, without waiting for
    new sales. Run it when the sales stream is not running. Whether any were
    looked at. Their rows lie under ``batch_id`` -1, -2, ..."""
    end_release(store)
    return Quarantine(store).begin_release(Quarantine(store).dimensions(DIM_NAMES)) is not None and end_release(store)


def end_release(store: TableStore) -> bool:
    number = Quarantine(store).releasing()
    if number is not None:
        _absorb_sales(None, -number, store)
    return number is not None


def _absorb_sales(batch: DataFrame | None, batch_id: int, store: TableStore) -> None:
    """A micro-batch, or (``None``) a release of held rows under a negative id."""
    quarantine = Quarantine(store)
    versions = quarantine.dimensions(DIM_NAMES)
    dims = {e: current_dimension(store, n) for e, n in DIM_NAMES.items()}
    held_as = None if batch is None else batch_id
    schema = bronze_schema("sales") if batch is None else batch.schema
    again = quarantine.due(held_as, versions, schema)
    parts = [df for df in (batch, again) if df is not None] or [store.spark.createDataFrame([], schema)]
    body = silver_plan.sales_body(reduce(DataFrame.unionByName, parts), None, None, None)
    checked = flagged(body, dims, "_kept").persist()
    try:
        clean = checked.where("_kept").drop("_kept")
        # The rules are counted by the writes themselves.
        seen: dict = {}

        def counted(df: DataFrame, dataset: str, rules) -> DataFrame:
            observed, seen[dataset] = quality.observed(df, dataset, rules)
            return quality.enforce(observed, rules)

        sales = silver_plan.sales_body_k1(counted(clean, "sales_cleaned", silver_plan.SALES_RULES))
        store.write_batch(counted(sales, "silver_sales", silver_plan.FACT_RULES), C.SILVER_SALES, batch_id)
        store.write_batch(counted(silver_plan.returns_body_k2(clean), "silver_returns", silver_plan.FACT_RULES),
                          C.SILVER_RETURNS, batch_id)
        facts = gold_plan.denormalized(silver_plan.silver_sales(clean), dims["customers"], dims["products"], dims["stores"])
        month = F.trunc(F.col("event_time").cast("date"), "month").alias(FACT_PARTITION)
        store.write_batch(facts.select("*", month), C.GOLD_FACTS, batch_id, partition_by=[FACT_PARTITION])
        rules = {"sales_cleaned": silver_plan.SALES_RULES, "silver_sales": silver_plan.FACT_RULES,
                 "silver_returns": silver_plan.FACT_RULES}
        rows = [row for name, obs in seen.items() for row in quality.metrics_rows(name, rules[name], obs.get)]
        record_quality(store, batch_id, [local_rows(store.spark, rows, quality.REPORT_FIELDS)])
        stored = store.spark.read.schema(facts.schema).parquet(f"{store.path(C.GOLD_FACTS)}/batch_id={batch_id}")
        if batch is None:
            DailyState(store).absorb(stored, quarantine.last_batch(), release=-batch_id)
        else:
            DailyState(store).absorb(stored, batch_id)
        quarantine.hold(checked.where("NOT _kept").select(schema.fieldNames()), held_as, versions, again is not None)
    finally:
        checked.unpersist()


def record_quality(store: TableStore, batch_id: int, reports: list[DataFrame]) -> None:
    """E3 counters of one micro-batch into the quality table; a retried batch replaces its own rows."""
    rows = quality.union_reports(reports).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    store.write(rows.coalesce(1), C.QUALITY_METRICS, partition_by=["dataset", "batch_id"], dynamic=True)


def read_daily(store: TableStore) -> DataFrame:
    """The streamed rollup (T7): a day without any line left holds one row
    without a store, which is not part of it."""
    return store.read(C.GOLD_DAILY_STORE).where("store_id IS NOT NULL")


def sales_stream(spark: SparkSession, store: TableStore, checkpoint: str, available_now: bool = True,
                 max_files_per_trigger: int | None = None) -> StreamingQuery:
    src = read_table_stream(spark, store, C.BRONZE_SALES, "sales", max_files_per_trigger)
    src = src.withWatermark("event_time", C.WATERMARK)  # T1: declared, drops nothing here
    writer = (src.writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(lambda df, bid: process_sales_batch(df, bid, store)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="15 seconds")
    return writer.start()
