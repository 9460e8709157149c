"""Streaming SCD2 (T4 on a stream, T5 out-of-order arrival).

The dimension is a versioned table (``sources.versions``): its open versions
lie in one part for each bucket of the key's hash, its closed versions and the
log of all changes in runs that batches add to. A micro-batch

1. writes its changes as a run of the log;
2. reads the open versions of the buckets it touches, nothing else, and splices:
   a key whose changes all come after its last one goes on from its open
   version, which holds everything that later versions depend on; only a key
   with a late change is built anew, from its rows of the log;
3. writes the touched buckets' open versions and the versions it closed;
4. switches to all of it by one manifest file.

A batch that dies anywhere before step 4 has changed nothing, and its retry
starts over; one that dies after it is replayed, and replays of a (key,
sequence) are absorbed. Closed versions carry the number of the build of their
key; those of an earlier build no longer count. The result equals the batch
SCD2 of all changes in any arrival order.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import config as C
from ..operators import quality, scd2
from ..operators.scd2 import END, START
from ..plans import silver as silver_plan
from ..sources.scd2_table import BUCKET, BUILD, LAST, closed_rows
from ..sources.store import TableStore
from ..sources.versions import Manifest, VersionedTable
from .ingest import BRONZE_NAMES, DIM_NAMES, read_table_stream, record_quality

OPEN = "_open"


def change_log_name(entity: str) -> str:
    return f"{C.SILVER}.{entity}_change_log"


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class StreamedDimension:
    """The stored form of one dimension. ``seq``, ``track`` and ``except_cols``
    are those of the batch operator; ``scale`` goes to it."""

    def __init__(self, table: VersionedTable, keys: list[str], seq: str, track, except_cols, buckets: int, **scale):
        self.table, self.keys, self.seq, self.track = table, keys, seq, track
        self.except_cols, self.buckets, self.scale = list(except_cols), buckets, scale

    def apply(self, batch: DataFrame) -> None:
        table, held = self.table, self.table.manifest()
        self._check(held)
        log = table.new_folder("log")
        table.write(batch.withColumn(BUCKET, bucket_of(self.keys, self.buckets)), log, [BUCKET])
        touched = sorted(int(n.split("=")[1]) for n in table.subfolders(table.location(log), BUCKET))
        if touched:
            changes = table.read([log], batch.schema, BUCKET).where(F.col(self.seq).isNotNull())
            versions = table.new_folder("versions")
            table.write(self._splice(held, changes, log, touched), versions, [OPEN, BUCKET])
            now_open = table.subfolders(f"{table.location(versions)}/{OPEN}=true", BUCKET)
            parts = {**held.parts, **{n.split("=")[1]: f"{versions}/{OPEN}=true/{n}" for n in now_open}}
            closed = [[f"{versions}/{OPEN}=false", 0]] if table.subfolders(table.location(versions), OPEN, ["false"]) else []
            table.commit(held, parts=parts, info={"buckets": self.buckets, "keys": self.keys, "schema": self._history_schema(batch.schema).json(), "log": batch.schema.json()},
                         runs={"closed": [*held.runs.get("closed", []), *closed], "log": [*held.runs.get("log", []), [log, 0]]})
        table.merge_runs("log", self._merge_log)
        table.merge_runs("closed", self._merge_closed)

    def _check(self, held: Manifest) -> None:
        if held.info and held.info["buckets"] != self.buckets:
            raise ValueError(f"{self.table.path} is stored in {held.info['buckets']} buckets, not {self.buckets}; rebuild it to change that")

    def _history_schema(self, changes: T.StructType) -> T.StructType:
        skip = {*self.keys, self.seq, *self.except_cols}
        cols = [f.name for f in changes.fields if f.name not in skip]
        stamp = changes[self.seq].dataType
        return T.StructType([*[T.StructField(c, changes[c].dataType) for c in [*self.keys, *cols]],
                             T.StructField(START, stamp), T.StructField(END, stamp), T.StructField(BUILD, T.LongType()), T.StructField(LAST, stamp)])

    def _splice(self, held: Manifest, changes: DataFrame, log: str, touched: list[int]) -> DataFrame:
        """The touched buckets' open versions, and the versions that this batch closed."""
        keys, seq, build = self.keys, self.seq, F.lit(held.version + 1).cast("bigint")
        schema = self._history_schema(changes.schema)
        names = schema.fieldNames()
        found = self.table.read([held.parts[str(b)] for b in touched if str(b) in held.parts], schema)
        before = found if found is not None else self.table.spark.createDataFrame([], schema)
        span = changes.groupBy(*keys).agg(F.min(seq).alias("_from"), F.max(seq).alias("_upto"))
        met = before.join(span, keys, "left")
        untouched = met.where("_from IS NULL").select(names)
        late = met.where(F.col("_from") <= F.col(LAST)).select(*keys)
        # On from the open version: it stands for the key's last change, as it holds the value of every column then.
        tails = met.where(F.col("_from") > F.col(LAST))
        tail_rows = tails.select(*[F.col(LAST).alias(seq) if c == seq else F.col(c) if c in names else F.lit(None).cast(changes.schema[c].dataType).alias(c)
                                   for c in changes.columns])
        on_time = changes.join(late, keys, "left_anti")
        history = self._build(on_time.unionByName(tail_rows))
        state = tails.select(*keys, F.col(START).alias("_start"), F.col(BUILD).alias("_held"), F.col(LAST).alias("_tail"))
        went_on = (history.join(state, keys, "left")
                   .withColumn(START, F.when(F.col(START) == F.col("_tail"), F.col("_start")).otherwise(F.col(START)))
                   .withColumn(BUILD, F.coalesce("_held", build)).drop("_start", "_held", "_tail"))
        last = span.join(before.select(*keys, F.col(LAST).alias("_was")), keys, "left").select(*keys, F.greatest("_upto", "_was").alias(LAST))
        if not late.isEmpty():  # else the log is not read
            runs = [f for f, _ in held.runs.get("log", [])]
            of_buckets = self.table.read([*runs, log], changes.schema, BUCKET, touched)
            went_on = went_on.unionByName(self._build(of_buckets.join(late, keys, "left_semi")).withColumn(BUILD, build))
        built = went_on.join(last, keys).select(names)
        return (built.unionByName(untouched).withColumn(LAST, F.when(F.col(END).isNull(), F.col(LAST)))
                .withColumn(OPEN, F.col(END).isNull()).withColumn(BUCKET, bucket_of(keys, self.buckets)))

    def _build(self, rows: DataFrame) -> DataFrame:
        return scd2.scd2(rows, self.keys, self.seq, self.track, self.except_cols, ignore_null_updates=True, **self.scale)

    def _merge_log(self, folders: list[str], new: str) -> bool:
        rows = self.table.read(folders, T.StructType.fromJson(json.loads(self.table.manifest().info["log"])), BUCKET)
        self.table.write(rows.withColumn(BUCKET, bucket_of(self.keys, self.buckets)).repartition(BUCKET), new, [BUCKET])
        return True

    def _merge_closed(self, folders: list[str], new: str) -> bool:
        """Only versions of their key's last build are written again."""
        held = self.table.manifest()
        rows = closed_rows(self.table, held, folders).withColumn(BUCKET, bucket_of(self.keys, self.buckets))
        self.table.write(rows.repartition(BUCKET), new, [BUCKET])
        return bool(self.table.subfolders(self.table.location(new), BUCKET))


def apply_changes(batch: DataFrame, batch_id: int, store: TableStore, log_name: str, target: str, keys: list[str], sequence_by: str,
                  track, except_cols, buckets: int, rules=(), dataset: str | None = None, **scale) -> None:
    """``rules`` (C1-C3 expectations) are counted on the batch body into the
    quality table, then applied, before the changes reach the log."""
    body = batch.persist() if rules else batch
    try:
        if rules:
            record_quality(store, batch_id, [quality.report(body, dataset or target, rules)])
        StreamedDimension(store.versioned(target, log=log_name), keys, sequence_by, track, except_cols, buckets, **scale).apply(quality.enforce(body, rules))
    finally:
        if rules:
            body.unpersist()


def dimension_stream(spark: SparkSession, store: TableStore, entity: str, checkpoint: str, buckets: int = 16, available_now: bool = True,
                     max_files_per_trigger: int | None = None, **scale) -> StreamingQuery:
    """C1-C3 then H1-H3 incrementally from the bronze table of ``entity``."""
    src = read_table_stream(spark, store, BRONZE_NAMES[entity], entity, max_files_per_trigger)
    body = silver_plan.BODIES[entity](src)
    return changes_stream(body, store, change_log_name(entity), DIM_NAMES[entity], [C.KEYS[entity]], C.SEQUENCE_COL, C.SCD2_TRACK[entity], C.SCD2_EXCEPT,
                          checkpoint, buckets, available_now, rules=silver_plan.CLEANSE_RULES[entity],
                          dataset=f"{entity}_cleaned", **scale)


def changes_stream(changes: DataFrame, store: TableStore, log_name: str, target: str, keys: list[str], sequence_by: str, track, except_cols,
                   checkpoint: str, buckets: int = 16, available_now: bool = True, rules=(), dataset: str | None = None,
                   **scale) -> StreamingQuery:
    writer = (changes.writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(lambda df, bid: apply_changes(df, bid, store, log_name, target, keys, sequence_by, track, except_cols,
                                                          buckets, rules, dataset, **scale)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="15 seconds")
    return writer.start()
