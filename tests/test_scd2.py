"""SCD2 change flow (T4/T5): FIXTURES.md section 3 plus properties."""

import itertools
from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shopfloor.operators.scd2 import END, START, current, scd2

SCHEMA = "customer_id int, name string, email string, points int, last_update_time timestamp"
ROWS = [  # arrival order 1..5 of FIXTURES.md
    (1, "A", "x@y.z", 5, datetime(2024, 1, 1, 10, 0)),
    (1, "B", None, 7, datetime(2024, 1, 1, 10, 20)),
    (1, "A", None, 6, datetime(2024, 1, 1, 10, 10)),
    (1, "B", "x@y.z", None, datetime(2024, 1, 1, 10, 30)),
    (1, "A", "x@y.z", 9, datetime(2024, 1, 1, 10, 40)),
]
EXPECTED = [
    ("A", "x@y.z", 6, datetime(2024, 1, 1, 10, 0), datetime(2024, 1, 1, 10, 20)),
    ("B", "x@y.z", 7, datetime(2024, 1, 1, 10, 20), datetime(2024, 1, 1, 10, 40)),
    ("A", "x@y.z", 9, datetime(2024, 1, 1, 10, 40), None),
]


def _versions(df):
    return sorted(((r["name"], r["email"], r["points"], r[START], r[END]) for r in df.collect()),
                  key=lambda v: v[3])


@pytest.mark.parametrize("order", list(itertools.permutations(range(5)))[::17])
def test_fixture_any_arrival_order(spark, order):
    df = spark.createDataFrame([ROWS[i] for i in order], SCHEMA)
    out = scd2(df, ["customer_id"], "last_update_time", ["name", "email"], ["last_update_time"])
    assert _versions(out) == EXPECTED


@pytest.mark.parametrize("hot_rows", [1, 2, 4])
def test_fixture_hot_key_chunks(spark, hot_rows):
    """The same key split into sequence chunks gives the same versions."""
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = scd2(df, ["customer_id"], "last_update_time", ["name", "email"], ["last_update_time"],
               hot_rows=hot_rows)
    assert _versions(out) == EXPECTED


def test_duplicate_sequence_keeps_smallest_row(spark):
    t = datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, "B", "b", 1, t), (1, "A", None, 2, t), (1, "A", "a", 3, t)], SCHEMA)
    out = scd2(df, ["customer_id"], "last_update_time", ["name", "email"], ["last_update_time"])
    assert _versions(out) == [("A", None, 2, t, None)]


def _events_feed(spark, sf):
    from shopfloor.sources import fixtures
    from shopfloor.sources.tables import ParquetTables

    return fixtures.customer_changes(ParquetTables(spark, sf))


def _brute_force(pdf: pd.DataFrame) -> set:
    """Plain per-key loop over the SURVEY 2.11 definition."""
    out = set()
    pdf = pdf.sort_values(["customer_id", "last_update_time", "name", "email", "loyalty_points"],
                          na_position="first")
    pdf = pdf.drop_duplicates(["customer_id", "last_update_time"], keep="first")
    for key, g in pdf.groupby("customer_id"):
        filled = {"name": None, "email": None, "loyalty_points": None}
        versions = []
        for _, row in g.iterrows():
            prev = dict(filled)
            for c in filled:
                if pd.notna(row[c]):
                    filled[c] = row[c]
            if not versions or (prev["name"], prev["email"]) != (filled["name"], filled["email"]):
                versions.append([row["last_update_time"], dict(filled)])
            else:
                versions[-1][1] = dict(filled)
        for i, (start, vals) in enumerate(versions):
            end = versions[i + 1][0] if i + 1 < len(versions) else None
            out.add((key, vals["name"], vals["email"], int(vals["loyalty_points"]) if vals["loyalty_points"]
                     is not None else None, pd.Timestamp(start), pd.Timestamp(end) if end is not None else None))
    return out


def _as_set(df):
    return {(r.customer_id, r.name, r.email, r.loyalty_points, pd.Timestamp(r[START]),
             pd.Timestamp(r[END]) if r[END] is not None else None) for r in df.collect()}


def test_events_feed_matches_brute_force_cold_and_hot(spark):
    from tests.conftest import SF_SMALL

    feed = _events_feed(spark, SF_SMALL)
    expected = _brute_force(feed.toPandas())
    cold = scd2(feed, ["customer_id"], "last_update_time", ["name", "email"], ["last_update_time"])
    hot = scd2(feed, ["customer_id"], "last_update_time", ["name", "email"], ["last_update_time"],
               hot_rows=5)
    assert _as_set(cold) == expected
    assert _as_set(hot) == expected


def test_intervals_contiguous_one_open_per_key(spark):
    from tests.conftest import SF_MID

    hist = scd2(_events_feed(spark, SF_MID), ["customer_id"], "last_update_time", ["name", "email"],
                ["last_update_time"], hot_rows=20)
    pdf = hist.toPandas().sort_values(["customer_id", START])
    for _, g in pdf.groupby("customer_id"):
        starts, ends = list(g[START]), list(g[END])
        assert pd.isna(ends[-1])
        assert all(pd.notna(e) for e in ends[:-1])
        assert ends[:-1] == starts[1:]
    assert current(hist).count() == pdf["customer_id"].nunique()


def test_no_ignore_null_updates_nulls_are_values(spark):
    df = spark.createDataFrame([ROWS[i] for i in (0, 2, 1)], SCHEMA)
    out = scd2(df, ["customer_id"], "last_update_time", ["name", "email"], ["last_update_time"],
               ignore_null_updates=False)
    got = _versions(out)
    assert [v[:2] for v in got] == [("A", "x@y.z"), ("A", None), ("B", None)]


def test_null_sequence_rejected(spark):
    df = spark.createDataFrame([(1, "A", "a", 1, None)], SCHEMA)
    assert scd2(df, ["customer_id"], "last_update_time", ["name"], ["last_update_time"]).count() == 0


@pytest.mark.parametrize("scale", [{}, {"hot_rows": 5}])
def test_streaming_scd2_equals_batch_in_six_shuffled_micro_batches(spark, scratch, scale):
    """SURVEY 2.11: the events change feed landed as 6 files in scrambled order
    and applied one file per micro-batch gives the batch SCD2 exactly."""
    from tests.conftest import SF_SMALL
    from shopfloor.config import SCD2_EXCEPT
    from shopfloor.sources.store import TableStore
    from shopfloor.streaming.scd2_stream import changes_stream

    feed = _events_feed(spark, SF_SMALL)
    src = f"{scratch}/changes"
    for i in (3, 0, 5, 1, 4, 2):
        feed.where(F.pmod(F.xxhash64("customer_id", "last_update_time"), F.lit(6)) == i) \
            .coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 1).parquet(src)
    store = TableStore(spark, f"{scratch}/store")
    changes_stream(stream, store, "silver.changes_log", "silver.changes_history", ["customer_id"],
                   "last_update_time", ["name", "email"], SCD2_EXCEPT, f"{scratch}/ckpt", buckets=4,
                   **scale).awaitTermination()
    streamed = store.read("silver.changes_history").drop("_bucket")
    batch = scd2(feed, ["customer_id"], "last_update_time", ["name", "email"], SCD2_EXCEPT)
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0


def test_many_hot_keys_equal_the_cold_path(spark):
    """No cap on hot keys; chunks grow with the key; the bounds depend on the rows only."""
    from shopfloor.operators.scd2 import chunk_bounds
    from shopfloor.sources import fixtures
    from shopfloor.sources.tables import ParquetTables
    from tests.conftest import SF_MID

    feed = fixtures.product_grades(ParquetTables(spark, SF_MID))
    args = (["product_id"], "last_update_time", ["grade", "state"], ["last_update_time"])
    cold, hot = scd2(feed, *args), scd2(feed, *args, hot_rows=12)
    bounds = chunk_bounds(feed, ["product_id"], "last_update_time", 12)
    assert bounds.count() >= 1500
    assert cold.count() == hot.count() and cold.exceptAll(hot.select(*cold.columns)).count() == 0
    again = chunk_bounds(feed.repartition(17), ["product_id"], "last_update_time", 12)
    assert sorted(map(str, bounds.collect())) == sorted(map(str, again.collect()))


def test_chunks_grow_with_the_key(spark):
    from shopfloor.operators.scd2 import chunk_bounds
    rows = spark.range(60_000).selectExpr("CAST(IF(id < 50000, 1, 2) AS INT) AS k", "id AS s")
    sizes = {r.k: len(r["_bounds"]) for r in chunk_bounds(rows, ["k"], "s", 1000).collect()}
    assert 40 <= sizes[1] <= 60 and 7 <= sizes[2] <= 13


def test_replays_of_one_sequence_are_one_row(spark):
    rows = spark.range(5000).selectExpr("1 AS customer_id", "concat('n', id % 3) AS name", "id % 40 AS last_update_time")
    out = scd2(rows, ["customer_id"], "last_update_time", ["name"], hot_rows=100)
    cold = scd2(rows, ["customer_id"], "last_update_time", ["name"])
    assert sorted(map(str, out.collect())) == sorted(map(str, cold.collect()))


@pytest.mark.parametrize("seq", ["concat('2024-', lpad(id % 97, 3, '0'))", "CAST(9007199254740993 + id % 97 AS BIGINT)",
                                 "CAST(id % 97 AS DECIMAL(38,18)) / 1000000000000000000", "date_add(DATE '2024-01-01', CAST(id % 97 AS INT))"])
def test_sequences_of_any_type_with_hot_keys(spark, seq):
    """Bounds are of the sequence's own type: no cast fails and none loses digits."""
    rows = spark.range(600).selectExpr("CAST(id % 2 AS INT) AS k", "concat('n', id % 97 % 5) AS name", f"{seq} AS seq")
    cold, hot = scd2(rows, ["k"], "seq", ["name"]), scd2(rows, ["k"], "seq", ["name"], hot_rows=20)
    assert cold.count() == hot.count() > 50 and cold.exceptAll(hot.select(*cold.columns)).count() == 0
