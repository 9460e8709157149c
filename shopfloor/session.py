"""Spark session set-up shared by the pipeline, the queries, the bench and the tests."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Runtime SQL settings every plan in this package assumes. All of them can be
# changed on a live session, so they are applied to sessions we did not build.
RUNTIME_CONF = {
    # Day windows and timestamp->date casts are UTC days.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Adaptive execution: coalesce small shuffle partitions, turn sort-merge
    # joins into broadcast joins when the measured build side is small, and
    # split skewed join partitions (one hot store / customer / product).
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Timestamps written without zone (the driver tables) read as TIMESTAMP_NTZ;
    # the bronze casts turn them into session-zone timestamps.
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    # What a task holds in sorts and hash tables follows what it reads, so this
    # does not grow with the tables: splits of a scan, and shuffled bytes a task.
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
}
#: Partitions of a shuffle at least, before adaptive execution puts small ones
#: together: enough that none is over the advisory size up to 16 GB shuffled.
INITIAL_PARTITIONS = 512


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    wanted = max(INITIAL_PARTITIONS, shuffle_partitions(spark))
    if int(spark.conf.get(initial, None) or 0) < wanted:
        spark.conf.set(initial, str(wanted))
    return spark


def build_session(
    app: str = "shopfloor",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session. On a cluster pass ``master=None`` and let
    spark-submit decide; tests and the bench pass ``local[N]``."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.ui.showConsoleProgress", "false")
    # Checkpoints go when nothing refers to them any more.
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for reliable checkpoints and lineage-cutting writes.

    Taken from ``spark.checkpoint.dir`` as the cluster names it. Only a local
    session without that setting (tests) gets a fresh private folder; on a
    cluster a machine-local folder would be lost with its executor, so we refuse.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="shopfloor-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
