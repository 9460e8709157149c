"""Landing zone: append-only parquet folders, one per entity (S1, S2, S5,
S12, S13). Schemas are always explicit; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from ..operators.ranking import global_row_number
from ..schemas import LANDING_SCHEMAS, bronze_columns
from .tables import local_rows


def conform(df: DataFrame, entity: str) -> DataFrame:
    """Columns of the landing schema, in order, with its types."""
    schema = LANDING_SCHEMAS[entity]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def append(df: DataFrame, path: str, entity: str) -> None:
    """One append per batch; a writer never rewrites landed files."""
    conform(df, entity).write.mode("append").parquet(path)


def read_batch(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """S2."""
    return spark.read.schema(LANDING_SCHEMAS[entity]).parquet(path)


def read_stream(spark: SparkSession, path: str, entity: str, max_files_per_trigger: int | None = None,
                fmt: str = "parquet") -> DataFrame:
    """Incremental scan of new files (``fmt='delta'`` when its jar is present)."""
    reader = spark.readStream.schema(LANDING_SCHEMAS[entity]).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def existing_keys(source: DataFrame, key: str) -> DataFrame:
    """The distinct keys already landed, as a DataFrame (never collected)."""
    return source.select(key).where(F.col(key).isNotNull()).distinct()


def existing_keys_at(spark: SparkSession, path: str, entity: str, key: str) -> DataFrame:
    """S12 over a landing folder; an empty result when nothing landed yet."""
    try:
        return existing_keys(read_batch(spark, path, entity), key)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
            raise
        field = LANDING_SCHEMAS[entity][key]
        return local_rows(spark, [], [(key, field.dataType.simpleString())])


def next_key(source: DataFrame, key: str) -> DataFrame:
    """Max + 1, or 1 on an empty table (one row)."""
    return source.agg((F.coalesce(F.max(key), F.lit(0)) + 1).cast("bigint").alias(f"next_{key}"))


def allocate_keys(batch: DataFrame, landed: DataFrame, key: str, order: list) -> DataFrame:
    """S13 for a whole batch: new keys next, next+1, ... in ``order``,
    numbered with the distributed row number (W4), no driver loop."""
    start = next_key(landed, key).first()[0]  # one scalar
    numbered = global_row_number(batch, order, "_rn")
    return (numbered.withColumn(key, (F.lit(start) + F.col("_rn") - 1).cast("int"))
            .drop("_rn", "_n"))


__all__ = ["append", "read_batch", "read_stream", "existing_keys", "existing_keys_at", "next_key",
           "allocate_keys", "conform", "bronze_columns"]
