"""Whole-file operations on the store's file system, by Hadoop's public API, so
that they work wherever Spark reads and writes."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(sc._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a folder; none if it is not there."""
    fs, target = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _fs(spark, path)
    stream = fs.open(target)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """A file that is there whole or not at all: written aside, then renamed.
    Fails if the name is taken, so of two writers one wins."""
    fs, target = _fs(spark, path)
    folder, name = path.rsplit("/", 1)
    _, aside = _fs(spark, f"{folder}/.{name}.new")
    stream = fs.create(aside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(target) or not fs.rename(aside, target):
        raise FileExistsError(f"{path} was written by another run")


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)
