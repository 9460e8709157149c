"""Reads of the driver's parquet tables (one file or directory per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class ParquetTables:
    """Lazy parquet reads under one folder. Nothing is read until an action;
    Catalyst prunes columns and pushes filters into each scan. Splits are left
    to the scan (``spark.sql.files.maxPartitionBytes``); no table is dealt out
    again for having few.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._opened: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        single = f"{self.root}/{name}.parquet"
        return single if os.path.exists(single) or "://" in self.root else f"{self.root}/{name}"

    def table(self, name: str) -> DataFrame:
        """The same DataFrame for every call."""
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(self.path(name))
        return self._opened[name]


def local_rows(spark: SparkSession, rows, fields: list[tuple[str, str]]) -> DataFrame:
    """A small fixed table (a handful of counters, a run id, a bounded key
    list) as a literal plan evaluated in the JVM: unlike ``createDataFrame``
    on Python rows it starts no Python worker."""
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(t).alias(n) for n, t in fields])
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, fields)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
