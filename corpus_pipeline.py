"""Corpus clean-up over ``documents``: each stage takes (spark, docs, sf_dir)
and returns a table that is written as Parquet in the shared folder and read
again as the next stage's docs. All stages but the last keep the columns of
``documents``.

Null, empty and blank texts pass through every filter but the classifier's,
which rates them like any other text; extra columns are kept; of rows that are
near copies, repeated rows included, one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.llm import decontam, pieces, quality, simhash, substring
from shopfloor.llm.common import materialize, read_table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier rejects (toxic, poor) go."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return simhash.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Word sequences that occur elsewhere too are cut out of the texts."""
    return substring.cut_texts(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too much of a benchmark item go."""
    return decontam.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' piece ids, ready for training."""
    coded = pieces.encode(docs.select("doc_id", "lang", "source", "text"), pieces.Vocabulary.load(pieces.MODEL_PATH))
    return coded.select(
        F.col("c0").alias("doc_id"), F.col("c1").alias("lang"), F.col("c2").alias("source"),
        F.size("ids").cast("long").alias("n_ids"), "ids")


STAGES = [
    ("quality_classifier", quality_filter),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece_encoding", sentencepiece_encoding),
]

#: The classifier, SimHash and the pieces have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
