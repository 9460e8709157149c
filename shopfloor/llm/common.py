"""Helpers shared by the text operators: reads, lineage cuts, row keys and a
byte-level numpy word kernel for Arrow batches."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Bytes of text that a kernel call works on (its arrays take some 40 times
#: that); one longer text is a call of its own.
CHUNK_BYTES = (1 << 20) - 64

#: Bytes that are white space: x09-x0D and x20.
SPACE_BYTES = bytes([0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder; what is
    written there goes when the driver ends."""
    path = f"{checkpoint_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"
    atexit.register(_forget, spark, path)
    return path


def _forget(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    if sc._jvm is None or sc._jsc is None:  # the session was stopped
        return
    with contextlib.suppress(Exception):  # the driver is ending; what is left is only disk
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost
    executors, and fixes values that several branches read."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_key(text: Column) -> Column:
    """With the id, names a row; rows equal in both get equal results."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def byte_table(members: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


#: `[^\x20\x09-\x0D]+`
NON_SPACE = ~byte_table(SPACE_BYTES)
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after A-Z became a-z
ALNUM = byte_table(bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100)))

#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_BASES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n; grown on demand."""
    have = _BASES.get(base)
    if have is None or len(have[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        have = _BASES[base] = (out[0], out[1])
    return have


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the output."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """64-bit hashes of values[start:end] for many ranges, from one prefix sum
    of a polynomial modulo 2**64; equal content has an equal hash."""
    up, down = _powers(base, len(values) + 1)
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=total[1:])
    return mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


WORD_BASE = 0x9E3779B97F4A7C15 | 1
GRAM_BASE = 0xC2B2AE3D27D4EB4F | 1


class Chunk:
    """Some texts of one batch as bytes, with the words found in them.

    ``lo`` is the batch row of the first text; words of text i are
    ``first[i]:first[i + 1]``; word j is ``data[starts[j]:ends[j]]``."""

    def __init__(self, lo: int, data: np.ndarray, offsets: np.ndarray, members: np.ndarray):
        self.lo, self.data, self.offsets = lo, data, offsets
        inside = members[data]
        before = np.empty_like(inside)
        if len(data):
            before[0] = False
            before[1:] = inside[:-1]
            cuts = offsets[:-1][offsets[:-1] < len(data)]
            before[cuts] = False
            self.starts = np.flatnonzero(inside & ~before)
            after = np.empty_like(inside)
            after[-1] = False
            after[:-1] = inside[1:]
            last = offsets[1:][offsets[1:] > 0] - 1
            after[last] = False
            self.ends = np.flatnonzero(inside & ~after) + 1
        else:
            self.starts = self.ends = np.zeros(0, dtype=np.int64)
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def word_hashes(self) -> np.ndarray:
        return range_hash(self.data, self.starts, self.ends, WORD_BASE)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.first))


def text_column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The column's UTF-8 bytes and its offsets; null is the empty text."""
    column = pc.fill_null(batch.column(batch.schema.get_field_index(name)), "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, dtype=np.uint8)
    return data, offsets


def spans_of(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer text stands alone."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def chunks(batch: pa.RecordBatch, name: str, members: np.ndarray, lower: bool = False) -> Iterator[Chunk]:
    data, offsets = text_column(batch, name)
    for lo, hi in spans_of(offsets):
        part = data[offsets[lo] : offsets[hi]]
        yield Chunk(lo, LOWER[part] if lower else part, offsets[lo : hi + 1] - offsets[lo], members)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i:i + width], for every i where that is whole."""
    out, span = x, 1
    while span < width:
        step = min(span, width - span)
        out = np.minimum(out[: len(out) - step], out[step:])
        span += step
    return out
