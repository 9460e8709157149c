"""Exact duplicates by a stateful stream: keyed state on disk, which never
expires, holds for each content digest how many rows had it, the stable id of
the row that stays and where that row's content lies (file and row in it).
A digest met again is a hit only if the bytes are the same: contents are
compared whole, never by digest alone. DataFrame and SQL functions only.

``absorb`` reads what has landed in a Parquet folder since it last ran;
``entries`` is the state; ``decide`` gives each row its verdict.

Null counts as the empty text, and empty texts are equal like any others. A
null id is smaller than every id; a group of null ids only has a null keep_id.
Of rows equal in id and text exactly one stays, that of the last file and row.
An empty table has no rows in the result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import materialize, scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Settings of the stream's own session: state lives in RocksDB on the executors' disks and is
#: checkpointed to the shared folder; its memory is bounded for each executor.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    # No disk set aside beforehand: there may be many small stores.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    """A-Z in lower case, every other character as it is; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def located(docs: DataFrame, digest: Callable[[Column], Column], id_col: str, text_col: str) -> DataFrame:
    """(digest, content, doc_id, file, row): where each row of a Parquet scan,
    batch or stream, comes from."""
    content = normalised(F.col(f"`{text_col}`"))
    return docs.select(digest(content).alias("digest"), content.alias("content"), F.col(f"`{id_col}`").alias("doc_id"),
                       F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def two_columns(spark: SparkSession, path: str, id_col: str, text_col: str) -> StructType:
    """What is read of a Parquet folder, so that no other column can clash."""
    return spark.read.parquet(path).select(f"`{id_col}`", f"`{text_col}`").schema


def exactly(path: str) -> str:
    """A pattern that only ``path`` meets: a stream takes a pattern whether it
    finds a file or a folder, a plain path only if that is a folder."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def stays() -> Column:
    """The row that stays, and its place, of the rows that are put together."""
    return F.max(F.struct("doc_id", "file", "row"))


def absorb(spark: SparkSession, path: str, checkpoint: str, digest: Callable[[Column], Column] = sha256,
           id_col: str = "doc_id", text_col: str = "text", max_files: int | None = None) -> None:
    """Bring the state under ``checkpoint`` up to all rows that have landed in
    ``path``. Rows of one digest are put together before the shuffle, so a hot
    digest costs each task one row; a run that is cut off continues from the
    checkpoint, each file counted once."""
    session = spark.newSession()
    for key, value in {**STATE_CONF, "spark.sql.shuffle.partitions": spark.conf.get("spark.sql.shuffle.partitions"),
                       "spark.sql.session.timeZone": "UTC"}.items():
        session.conf.set(key, value)
    reader = session.readStream.schema(two_columns(spark, path, id_col, text_col))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = located(reader.parquet(exactly(path)), digest, id_col, text_col)
    state = rows.groupBy("digest").agg(stays().alias("top"), F.count("*").alias("n"))
    query = (state.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def entries(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(digest, top, n): the state as the last finished batch left it."""
    held = spark.read.format("statestore").load(checkpoint)
    return held.select("key.digest", F.col("value.max").alias("top"), F.col("value.count").alias("n"))


def decide(docs: DataFrame, state: DataFrame, digest: Callable[[Column], Column] = sha256,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, file, row, digest, keep_id, group_size, kept), one row per row
    of ``docs``, a Parquet scan of rows that the state has absorbed.

    Whole contents are grouped under their digest, copies within a task before
    the shuffle, so that a hot group costs each task one text. A digest is true
    if one content has all the rows that the state counted under it; its rows
    take the state's verdict. Rows of any other digest met by chance: each of
    its contents is a group of its own.
    """
    rows = located(docs, digest, id_col, text_col)
    own = state.select("digest", "top", F.col("n").alias("met"))
    contents = rows.groupBy("digest", "content").agg(F.count("*").alias("n")).drop("content")
    chance = materialize(contents.join(own, "digest").where("n < met").select("digest").distinct(), "chance")
    slim = rows.drop("content")
    if chance.isEmpty():
        return _verdicts(slim, own, ["digest"])
    mixed = rows.join(chance, "digest", "left_semi")
    apart = mixed.groupBy("digest", "content").agg(stays().alias("top"), F.count("*").alias("met"))
    return _verdicts(slim.join(chance, "digest", "left_anti"), own, ["digest"]).unionAll(
        _verdicts(mixed, apart, ["digest", "content"]))


def _verdicts(rows: DataFrame, groups: DataFrame, key: list[str]) -> DataFrame:
    return rows.join(groups, key).select(
        "doc_id", "file", "row", "digest", F.col("top.doc_id").alias("keep_id"), F.col("met").alias("group_size"),
        ((F.col("top.file") == F.col("file")) & (F.col("top.row") == F.col("row"))).alias("kept"))


def deduplicate(spark: SparkSession, path: str, checkpoint: str | None = None, digest: Callable[[Column], Column] = sha256,
                id_col: str = "doc_id", text_col: str = "text", max_files: int | None = None) -> DataFrame:
    """Absorb what has landed in ``path`` and give every row in it its verdict.
    With a ``checkpoint`` of the caller's, the state goes on from run to run."""
    checkpoint = checkpoint or scratch_path(spark, "exact")
    absorb(spark, path, checkpoint, digest, id_col, text_col, max_files)
    docs = spark.read.schema(two_columns(spark, path, id_col, text_col)).parquet(path)
    return decide(docs, entries(spark, checkpoint), digest, id_col, text_col)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(spark, f"{sf_dir.rstrip('/')}/documents.parquet").select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP11_SQL = """
WITH texts AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS content
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY content) AS keep_id, count(*) OVER (PARTITION BY content) AS group_size,
       row_number() OVER (PARTITION BY content ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
FROM texts"""
