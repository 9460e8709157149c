"""Bronze: typed projection of a landing feed plus lineage."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import KEYS
from ..operators.quality import FAIL, Expectation, enforce
from ..schemas import BRONZE_TYPES


def rules(entity: str) -> list[Expectation]:
    key = KEYS[entity]
    return [Expectation(f"valid_{key}", f"{key} IS NOT NULL", FAIL)]


def typed(entity: str) -> list[Column]:
    """One projection of ``try_cast`` per column: a value that does not parse
    or fit becomes NULL instead of failing the job (ANSI ``cast`` would raise)."""
    return [F.col(name).try_cast(kind).alias(name) for name, kind in BRONZE_TYPES[entity]]


def source_file(landing: DataFrame) -> Column:
    """The file of each row. A feed made of several tables names it itself;
    a file scan has it as metadata; rows from elsewhere have none."""
    if "source_file_path" in landing.columns:
        return F.col("source_file_path")
    try:
        landing.select("_metadata.file_path")
    except AnalysisException:
        return F.lit(None).cast("string").alias("source_file_path")
    return F.col("_metadata.file_path").alias("source_file_path")


def bronze(landing: DataFrame, entity: str, run_ts: datetime | None = None) -> DataFrame:
    """``run_ts`` is one literal per pipeline update (taken once in Python, not
    per row or micro-batch); without a zone it is read as UTC."""
    taken = run_ts or datetime.now(timezone.utc)
    if taken.tzinfo is None:
        taken = taken.replace(tzinfo=timezone.utc)
    cols = [*typed(entity), F.lit(taken).cast("timestamp").alias("ingest_timestamp"), source_file(landing)]
    return enforce(landing.select(*cols), rules(entity))
