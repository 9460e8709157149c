"""The streamed SCD2: crash safety, splicing, bounded folders."""
import pytest
from pyspark.sql import functions as F

from shopfloor.operators.scd2 import scd2
from shopfloor.sources.scd2_table import open_versions
from shopfloor.sources.store import TableStore
from shopfloor.sources.versions import FAN, VersionedTable
from shopfloor.streaming.scd2_stream import StreamedDimension, apply_changes

SCHEMA = "k int, name string, email string, points int, seq int, noise string"


def feed(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def changes(n=240, keys=24):
    """Changes with nulls, repeats of a sequence and untracked columns."""
    return [(i * 7 % keys, None if i % 5 == 0 else f"n{i % 11 % 3}", f"e{i % 13 % 4}" if i % 3 else None, i if i % 2 else None, i * 31 % 97, "x") for i in range(n)]


def dimension(store, name="silver.dim", **scale):
    return StreamedDimension(store.versioned(name, log="silver.log"), ["k"], "seq", ["name", "email"], ["seq", "noise"], 4, **scale)


def expected(spark, rows):
    return sorted(map(str, scd2(feed(spark, rows), ["k"], "seq", ["name", "email"], ["seq", "noise"]).collect()))


def stored(store, name="silver.dim"):
    return sorted(map(str, store.read(name).collect()))


@pytest.mark.parametrize("order,scale", [("in order", {}), ("late", {}), ("scrambled", {"hot_rows": 4})])
def test_any_arrival_order_equals_batch(spark, scratch, order, scale):
    rows = changes()
    key = {"in order": lambda r: r[4], "late": lambda r: -r[4], "scrambled": lambda r: r[4] * 57 % 89}[order]
    rows = sorted(rows, key=key)
    store = TableStore(spark, scratch)
    dim = dimension(store, **scale)
    for i in range(4):
        dim.apply(feed(spark, rows[i * 60 : (i + 1) * 60]))
    assert stored(store) == expected(spark, rows)
    assert sorted(map(str, open_versions(dim.table).collect())) == sorted(map(str, store.read("silver.dim").where("__END_AT IS NULL").collect()))


def test_on_time_changes_read_open_versions_only(spark, scratch, monkeypatch):
    """What a batch reads does not grow with the log: neither log nor closed versions are read."""
    store = TableStore(spark, scratch)
    dim = dimension(store)
    read = []
    real = VersionedTable.read
    monkeypatch.setattr(VersionedTable, "read", lambda self, folders, *a, **k: (read.append(list(folders)), real(self, folders, *a, **k))[1])
    sizes = []
    for batch in range(4):
        read.clear()
        dim.apply(feed(spark, [(k, f"n{batch}", None, batch, 100 * batch + k, "x") for k in range(12)]))
        kinds = [f.split("-")[0] + ("/open" if "/_open=true" in f else "/closed" if "/_open=false" in f else "") for fs in read for f in fs]
        assert set(kinds) <= {"log", "versions/open"} and kinds.count("log") == 1  # its own changes
        sizes.append(len(kinds))
    assert max(sizes) <= 1 + 4
    assert store.read("silver.dim").count() == 4 * 12


def test_a_batch_stopped_anywhere_and_retried_equals_batch(spark, scratch, monkeypatch):
    """40 keys; the writer dies between any two file operations of the second batch."""
    first = [(k, f"a{k}", None, k, 10, "x") for k in range(40)]
    second = [(k, f"b{k}", "e", None, 5 if k % 2 else 20, "x") for k in range(0, 40, 3)]
    steps = []

    class Stopped(Exception):
        pass

    def stop_at(n):
        def step(self, what):
            steps.append(what)
            if len(steps) == n:
                raise Stopped(what)
        return step

    at, done = 0, False
    while not done:
        at += 1
        store = TableStore(spark, f"{scratch}/{at}")
        monkeypatch.setattr(VersionedTable, "step", lambda self, what: None)
        dimension(store).apply(feed(spark, first))
        before = stored(store)
        steps.clear()
        monkeypatch.setattr(VersionedTable, "step", stop_at(at))
        try:
            dimension(store).apply(feed(spark, second))
            done = True
        except Stopped:
            assert stored(store) == (before if steps[-1] != "committed" else expected(spark, first + second))
            monkeypatch.setattr(VersionedTable, "step", lambda self, what: None)
            dimension(store).apply(feed(spark, second))
        assert stored(store) == expected(spark, first + second)
    assert at > 6


def test_many_batches_leave_few_folders(spark, scratch):
    """Runs are merged in tiers; a merge that dies leaves the table as it was."""
    store = TableStore(spark, scratch)
    dim, rows = dimension(store), []
    for i in range(FAN + 3):
        part = [(i % 5, f"n{i}", None, i, (i * 37) % 50, "x"), (7, f"m{i}", None, i, i, "x")]
        rows += part
        dim.apply(feed(spark, part))
    held = dim.table.manifest()
    assert all(len(runs) <= FAN for runs in held.runs.values()) and any(level for _, level in held.runs["log"])
    assert stored(store) == expected(spark, rows)
    dim.table.vacuum(keep=1)
    assert stored(store) == expected(spark, rows)
    left = {f.split("/")[-1] for f in [*map(str, (spark.sparkContext._jvm.java.io.File(f"{scratch}/silver/dim/_data").list()))]}
    assert left == {f for f in held.folders() if not f.startswith("log")}
    dim.apply(feed(spark, [(0, "late", None, 1, -5, "x")]))
    assert stored(store) == expected(spark, rows + [(0, "late", None, 1, -5, "x")])


def test_a_second_writer_loses(spark, scratch):
    store = TableStore(spark, scratch)
    dimension(store).apply(feed(spark, [(1, "a", None, 1, 1, "x")]))
    table = store.versioned("silver.dim")
    held = table.manifest()
    table.commit(held)
    with pytest.raises(FileExistsError):
        table.commit(held)


def test_empty_batches_and_changes_without_a_sequence(spark, scratch):
    store = TableStore(spark, scratch)
    dim = dimension(store)
    dim.apply(feed(spark, []))
    assert not dim.table.exists()
    dim.apply(feed(spark, [(1, "a", None, 1, None, "x"), (2, "b", None, 1, 3, "x")]))
    dim.apply(feed(spark, []))
    dim.apply(feed(spark, [(1, "a", None, 1, None, "x")]))
    assert [r.k for r in store.read("silver.dim").collect()] == [2]


def test_a_string_sequence(spark, scratch):
    store = TableStore(spark, scratch)
    rows = [(i % 3, f"n{i % 4}", f"2024-01-{i:02d}") for i in (3, 1, 9, 4, 7, 2, 8, 5, 6)]
    make = lambda part: spark.createDataFrame(part, "k int, name string, seq string")
    for i in range(0, 9, 3):
        apply_changes(make(rows[i : i + 3]), i, store, "silver.log", "silver.dim", ["k"], "seq", ["name"], ["seq"], 2)
    want = scd2(make(rows), ["k"], "seq", ["name"], ["seq"])
    assert stored(store) == sorted(map(str, want.select(store.read("silver.dim").columns).collect()))
    assert store.read("silver.dim").agg(F.count("*")).first()[0] == want.count()
