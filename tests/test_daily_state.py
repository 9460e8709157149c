"""The rollup from mergeable state equals G2 over all facts."""
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shopfloor.plans import gold
from shopfloor.sources.store import TableStore
from shopfloor.sources.versions import FAN, VersionedTable
from shopfloor.streaming.daily_state import DailyState, customers_over
from shopfloor.streaming.ingest import read_daily

FACTS = "transaction_id int, event_time timestamp, customer_id int, store_id int, store_name string, quantity int, total_amount double"


def facts(spark, n, seed, days=3):
    start = datetime(2024, 1, 30)
    rows = [(i, start + timedelta(days=(i * seed) % days, hours=i % 24) if i % 17 else None, [None, 5, 40_000, -3, 2**31 - 1, i % 7][i % 6],
             i % 2, "s", (i % 5) - 1, [0.125, 10.0, 3.335][i % 3]) for i in range(n)]
    return spark.createDataFrame(rows, FACTS)


def same(store, every):
    want = gold.daily_by_store(every.where("event_time IS NOT NULL"))
    got = read_daily(store).select(want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_batches_and_replays_equal_one_pass(spark, scratch):
    store = TableStore(spark, scratch)
    state = DailyState(store)
    parts = [facts(spark, 40, s) for s in (1, 2, 5)]
    for i, part in enumerate(parts):
        state.absorb(part, i)
    same(store, parts[0].unionAll(parts[1]).unionAll(parts[2]))
    state.absorb(parts[2], 2)  # a replay
    same(store, parts[0].unionAll(parts[1]).unionAll(parts[2]))
    state.absorb(facts(spark, 0, 1), 2)  # a retry without rows
    same(store, parts[0].unionAll(parts[1]))
    every = parts[0].unionAll(parts[1])
    true = every.where("event_time >= '2024-01-30' AND event_time < '2024-02-01'").groupBy("store_id", "store_name").agg(
        F.countDistinct("customer_id").alias("unique_customers"))
    assert sorted(map(str, customers_over(state.state(), "2024-01-30", "2024-01-31").collect())) == sorted(map(str, true.collect()))


def test_days_of_a_batch_that_died_twice(spark, scratch, monkeypatch):
    """First days 1-3, then, cut off before the rollup, only day 1: days 2 and 3 are not forgotten."""
    store = TableStore(spark, scratch)
    state = DailyState(store)
    state.absorb(facts(spark, 30, 1), 0)
    real = DailyState._write_days
    for _ in range(2):
        monkeypatch.setattr(DailyState, "_write_days", lambda self, days: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            state.absorb(facts(spark, 10, 1, days=1), 0)
    monkeypatch.setattr(DailyState, "_write_days", real)
    state.absorb(facts(spark, 10, 1, days=1), 0)
    same(store, facts(spark, 10, 1, days=1))


def test_many_batches_leave_few_runs_and_read_their_days_only(spark, scratch, monkeypatch):
    store = TableStore(spark, scratch)
    state, every = DailyState(store), None
    for i in range(FAN + 2):
        part = facts(spark, 6, 1, days=1 + i % 2)
        every = part if every is None else every.unionAll(part)
        state.absorb(part, i)
    runs = state.table.manifest().runs["state"]
    assert len(runs) <= FAN and any(level for _, level in runs)
    same(store, every)
    with pytest.raises(ValueError, match="merged"):
        state.absorb(facts(spark, 1, 1), 0)
    read = []
    real = VersionedTable.location
    monkeypatch.setattr(VersionedTable, "location", lambda self, f: (read.append(f), real(self, f))[1])
    assert set(state.state(["2030-01-01"]).columns) >= {"sale_date", "customers"} and state.state(["2030-01-01"]).count() == 0
