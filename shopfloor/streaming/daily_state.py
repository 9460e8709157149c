"""Incremental daily rollup (T7) from mergeable state.

COUNT(DISTINCT) cannot be added up, bitmaps can: each micro-batch leaves, for
each (day, store) it sold on, exact sums and one bitmap of customer ids for each
block of ids. The rollup of a day is the state of that day put together: sums
added, bitmaps united. A batch reads its own facts and the state of its days,
never stored facts.

State lies in a versioned table, one run for each batch, so a retry replaces its
batch's run at one stroke and older runs are merged in tiers. Days whose rollup
is not written yet stand in the manifest, so that they are known to any later
attempt, however often a batch dies.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.money import money_sum, round2_double
from ..sources.store import TableStore
from ..sources.tables import local_rows
from ..sources.versions import VersionedTable

STATE = "gold.daily_store_state"
DAY = "sale_date"
GROUP = ["store_id", "store_name"]
SCHEMA = (f"{DAY} date, store_id int, store_name string, block bigint, customers binary, revenue decimal(38,6), "
          "transactions bigint, items bigint")
COLUMNS = [c.split(" ")[0] for c in SCHEMA.split(", ")]


def partial(facts: DataFrame) -> DataFrame:
    """The state of some facts; a line without a time belongs to no day.

    Lines become one row for each customer of a store and day before any bitmap
    (4 KB each) is made. Bitmaps are then made in the order of (store, block,
    day), one at a time: none is shuffled or sorted, here or where
    ``customers_over`` unites them."""
    day = F.col("event_time").cast("date")
    visits = (facts.where(day.isNotNull()).groupBy(*GROUP, day.alias(DAY), "customer_id")
              .agg(money_sum("total_amount").cast("decimal(38,6)").alias("revenue"),
                   F.count("transaction_id").alias("transactions"), F.sum("quantity").cast("bigint").alias("items"))
              .withColumn("block", F.bitmap_bucket_number("customer_id")))
    return (visits.repartition(*GROUP, "block").groupBy(*GROUP, "block", DAY)
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("customer_id")).alias("customers"),
                 F.sum("revenue").cast("decimal(38,6)").alias("revenue"),
                 F.sum("transactions").alias("transactions"), F.sum("items").alias("items"))
            .select(COLUMNS))


def merged(state: DataFrame) -> DataFrame:
    """State put together: a row per (day, store, block)."""
    return state.groupBy(DAY, *GROUP, "block").agg(
        F.bitmap_or_agg("customers").alias("customers"), F.sum("revenue").cast("decimal(38,6)").alias("revenue"),
        F.sum("transactions").alias("transactions"), F.sum("items").alias("items"))


def daily_from_state(state: DataFrame) -> DataFrame:
    """G2 from state."""
    return (merged(state).groupBy(DAY, *GROUP)
            .agg(F.sum("revenue").alias("_revenue"), F.sum("transactions").alias("total_transactions"),
                 F.sum("items").alias("total_items_sold"), F.sum(F.bitmap_count("customers")).alias("unique_customers"))
            .select(DAY, *GROUP, round2_double(F.col("_revenue")).alias("total_revenue"), "total_transactions",
                    "total_items_sold", "unique_customers"))


def customers_over(state: DataFrame, lo, hi) -> DataFrame:
    """True distinct customers of each store over days ``lo`` to ``hi``, from
    state: a repeat customer counts once, however many days they came."""
    days = state.where(F.col(DAY).between(F.lit(lo).cast("date"), F.lit(hi).cast("date")))
    return (days.groupBy(*GROUP, "block").agg(F.bitmap_or_agg("customers").alias("customers"))
            .groupBy(*GROUP).agg(F.sum(F.bitmap_count("customers")).alias("unique_customers")))


def store_customers(facts: DataFrame, lo, hi) -> DataFrame:
    """Per store, the customers of a date range counted once each next to the
    published figure, the sum of the days' counts (Q12), which counts a customer
    again on every day. Both come from one pass of the facts into state."""
    day = F.col("event_time").cast("date")
    state = partial(facts.where(day.between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))))
    days = state.groupBy(DAY, *GROUP).agg(F.sum(F.bitmap_count("customers")).alias("n")).groupBy(*GROUP).agg(F.sum("n").alias("summed_daily_customers"))
    return days.join(customers_over(state, lo, hi), GROUP).select(*GROUP, "summed_daily_customers", "unique_customers")


class DailyState:
    def __init__(self, store: TableStore, table: VersionedTable | None = None):
        self.store = store
        self.table = table or store.versioned(STATE)

    def absorb(self, facts: DataFrame, batch_id: int, release: int | None = None) -> None:
        """One micro-batch's facts, in place of what an earlier attempt left; or
        those of a ``release`` of held rows after that batch."""
        held = self.table.manifest()
        if release is None and batch_id <= held.info.get("merged", -1):
            raise ValueError(f"batch {batch_id} is part of merged state; only a full refresh can replay it")
        # The rest of a folder's name is hexadecimal, so no batch's own begins with r.
        own = f"state-{batch_id}" if release is None else f"state-{batch_id}-r{release}"
        mine = [f for f, _ in held.runs.get("state", [])
                if f.startswith(f"{own}-") and (release is not None or not f.startswith(f"{own}-r"))]
        folder = self.table.new_folder(own)
        self.table.write(partial(facts).hint("rebalance", DAY), folder, [DAY])
        days = {d for f in [*mine, folder] for d in self._days(f)} | set(held.info.get("pending", []))
        runs = [r for r in held.runs.get("state", []) if r[0] not in mine]
        added = [[folder, 0]] if self._days(folder) else []
        held = self.table.commit(held, runs={"state": [*runs, *added]}, info={**held.info, "pending": sorted(days)})
        if days:
            self._write_days(sorted(days))
        self.table.commit(held, info={**held.info, "pending": []})
        self._merge(batch_id)

    def _days(self, folder: str) -> list[str]:
        return [n.split("=")[1] for n in self.table.subfolders(self.table.location(folder), DAY)]

    def state(self, days: list[str] | None = None, folders: list[str] | None = None) -> DataFrame:
        """Stored state, of all days or some."""
        if folders is None:
            folders = [f for f, _ in self.table.manifest().runs.get("state", [])]
        if days is not None:
            folders = [f for f in folders if set(days) & set(self._days(f))]
        parts = [self.store.spark.read.schema(SCHEMA).parquet(self.table.location(f)).select(COLUMNS) for f in folders]
        if not parts:
            return self.store.spark.createDataFrame([], SCHEMA)
        every = parts[0]
        for part in parts[1:]:
            every = every.unionAll(part)
        return every if days is None else every.where(F.col(DAY).isin([date.fromisoformat(d) for d in days]))

    def _write_days(self, days: list[str]) -> None:
        """Replace the rollup of some days. A day that lost its last line keeps
        an empty marker row out of the rollup."""
        daily = daily_from_state(self.state(days))
        marked = local_rows(self.store.spark, [(d,) for d in days], [(DAY, "string")]).select(F.col(DAY).cast("date"))
        daily = daily.join(marked, DAY, "right").select(daily.columns)
        self.store.write(daily, C.GOLD_DAILY_STORE, partition_by=[DAY], dynamic=True)

    def _merge(self, batch_id: int) -> None:
        """Runs of earlier batches become one now and then; this batch's own
        run stays apart, as its retry may still replace it."""
        def merge(old: list[str], new: str) -> bool:
            self.table.write(merged(self.state(folders=old)).hint("rebalance", DAY), new, [DAY])
            return True

        own = f"state-{batch_id}-"
        done = [int(f.split("-")[1]) for f, _ in self.table.manifest().runs.get("state", []) if not f.startswith((own, "state-merged"))]
        self.table.merge_runs("state", merge, keep=lambda folder: folder.startswith(own),
                              info=lambda old: {"merged": max([d for d in done if any(f.startswith(f"state-{d}-") for f in old)], default=-1)})
