"""Parquet table store for the pipeline layers.

Tables live under ``{root}/{layer}/{table}``. A full refresh (T6) writes a
whole new run folder ``{root}/runs/{run_id}`` and then publishes it by adding
one row to a pointer table: the commit of an append is one new file, so
readers find the old run or the new one, never neither. They resolve the
pointer once and never see a half-written refresh; old runs stay readable
until removed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import COMMENTS, CURRENT_VIEWS
from . import files, scd2_table
from .tables import local_rows
from .versions import VersionedTable


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def write(self, df: DataFrame, name: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
              dynamic: bool = False) -> None:
        """Full recompute (overwrite); ``dynamic`` replaces only the
        partitions present in ``df`` (idempotent re-writes of a batch)."""
        writer = df.write.mode(mode)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if dynamic:
            writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.parquet(self.path(name))

    def write_batch(self, df: DataFrame, name: str, batch_id: int, partition_by: Sequence[str] = ()) -> None:
        """One micro-batch's rows in a folder of their own, ``batch_id=N``, which
        a retry replaces whole, also with fewer rows or none."""
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.path(name)}/batch_id={batch_id}")

    def drop(self, name: str) -> None:
        """Remove a stored table's folder."""
        files.delete(self.spark, self.path(name))

    def versioned(self, name: str, log: str | None = None) -> VersionedTable:
        """A table whose folders a manifest names; its log may have a name of its own."""
        return VersionedTable(self.spark, self.path(name), {"log": self.path(log)} if log else None)

    def read(self, name: str, schema=None) -> DataFrame:
        if schema is None and self.versioned(name).exists():
            return scd2_table.history(self.versioned(name))
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(self.path(name))

    def exists(self, name: str) -> bool:
        if self.versioned(name).exists():
            return True
        try:
            self.spark.read.parquet(self.path(name)).schema  # noqa: B018
            return True
        except AnalysisException:
            return False

    def register(self, names: Sequence[str] | None = None) -> list[str]:
        """Temp views named like the tables without their layer
        (``gold.x`` -> ``x``), commented; silver dimensions also get their
        current view (``silver_x_current``). ``None`` registers every stored
        dataset. Returns the view names."""
        views = []
        for name in names if names is not None else [n for n in COMMENTS if self.exists(n)]:
            table = self.read(name)
            self._view(table, name.split(".")[-1], COMMENTS.get(name, ""))
            views.append(name.split(".")[-1])
            if name in CURRENT_VIEWS:
                self._view(table.where("__END_AT IS NULL"), CURRENT_VIEWS[name], f"Open versions of {name}")
                views.append(CURRENT_VIEWS[name])
        return views

    def _view(self, df: DataFrame, view: str, comment: str) -> None:
        """A temp view whose columns carry the dataset's comment as metadata
        (temp views of DataFrames have no comment of their own)."""
        noted = [F.col(f"`{f.name}`").alias(f.name, metadata={**f.metadata, "dataset_comment": comment}) for f in df.schema.fields]
        df.select(*noted).createOrReplaceTempView(view)

    def create_tables(self, database: str | None = None, names: Sequence[str] | None = None) -> list[str]:
        """Tables of the session catalog over the stored folders, one
        database for each layer or all in ``database``, with COMMENT ON TABLE;
        views of a dimension's open versions next to it. Tables are external:
        dropping one leaves its files. A dimension that a stream keeps becomes a
        view of the folders its manifest names now; call again after a batch.
        Returns the qualified names."""
        made = []
        for name in names if names is not None else [n for n in COMMENTS if self.exists(n)]:
            layer, table = name.split(".")
            layer = database or layer
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}` LOCATION '{self.root}/_databases/{layer}'")
            qualified = f"`{layer}`.`{table}`"
            versioned = self.versioned(name)
            if versioned.exists():
                text = scd2_table.history_sql(versioned)
                self.spark.sql(f"CREATE OR REPLACE VIEW {qualified} COMMENT {_literal(COMMENTS.get(name, ''))} AS {text}")
            else:
                self.spark.sql(f"DROP TABLE IF EXISTS {qualified}")
                self.spark.catalog.createTable(f"{layer}.{table}", path=self.path(name), source="parquet")
                if any(c.isPartition for c in self.spark.catalog.listColumns(f"{layer}.{table}")):
                    self.spark.catalog.recoverPartitions(f"{layer}.{table}")  # the catalog lists a table's partitions itself
                self.spark.sql(f"COMMENT ON TABLE {qualified} IS {_literal(COMMENTS.get(name, ''))}")
            made.append(f"{layer}.{table}")
            if name in CURRENT_VIEWS:
                view = f"`{layer}`.`{CURRENT_VIEWS[name]}`"
                self.spark.sql(f"CREATE OR REPLACE VIEW {view} COMMENT {_literal(f'Open versions of {name}')} AS "
                               f"SELECT * FROM {qualified} WHERE __END_AT IS NULL")
                made.append(f"{layer}.{CURRENT_VIEWS[name]}")
        return made

    def comment(self, view: str) -> str:
        """The comment attached to a registered view."""
        return self.spark.table(view).schema.fields[0].metadata.get("dataset_comment", "")


class RunStore:
    """Versioned runs under one root with a published pointer."""

    POINTER = "_published"

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def run(self, run_id: str) -> TableStore:
        return TableStore(self.spark, f"{self.root}/runs/{run_id}")

    def _published(self) -> DataFrame:
        return self.spark.read.schema("run_id string, number bigint").parquet(f"{self.root}/{self.POINTER}")

    def publish(self, run_id: str) -> None:
        """Runs are numbered as they are published: one that started early and
        finished last is the current one."""
        try:
            last = self._published().agg(F.max("number")).first()[0]
        except AnalysisException:  # the first run
            last = None
        local_rows(self.spark, [(run_id, (last or 0) + 1)], [("run_id", "string"), ("number", "bigint")]).coalesce(1).write.mode(
            "append").parquet(f"{self.root}/{self.POINTER}")

    def current(self) -> TableStore:
        """The run published last."""
        newest = self._published().agg(F.max_by("run_id", F.struct(F.coalesce("number", F.lit(0)), "run_id"))).first()[0]
        if newest is None:
            raise LookupError(f"no run is published under {self.root}")
        return self.run(newest)
