"""SimHash near-duplicate groups by pigeonhole blocks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, read_table, text_column, text_key
from .components import connected

SHINGLE_WORDS = 3
MAX_BITS = 3
HASH_SEED = 42

#: Distinct fingerprints in one block bucket beyond which its rest is split again.
BUCKET_ROWS = 256

#: Masks that a plan holds as literals: three levels at three bits.
MASKS = 8000


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit SimHash of the A-Z-folded, white-space separated words'
    shingles, repeats included; a bit is set if over half the hashes set it.
    A text of fewer words is one shingle; without words the fingerprint is 0."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.array([xxhash.xxh64_intdigest(g, HASH_SEED) for g in grams], dtype=">u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, fp) per row of ``docs``; a null text has no words."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_column(batch, "text")
            fps = [fingerprint(data[lo:hi].tobytes(), shingle) for lo, hi in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.int64())], ["doc_id", "text_key", "fp"])

    return rows.mapInArrow(run, f"doc_id {id_type}, text_key long, fp long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def block_masks(free: list[int], max_bits: int) -> list[tuple[int, list[int]]]:
    """Cut the free bit positions into max_bits + 3 blocks. Two values that
    differ in at most max_bits of them agree on three blocks at least: one
    mask for each choice of three, with the positions it leaves free."""
    cuts = np.linspace(0, len(free), max_bits + 4).round().astype(int)
    parts = [free[lo:hi] for lo, hi in zip(cuts[:-1], cuts[1:])]
    out = []
    for chosen in combinations(range(len(parts)), 3):
        fixed = {p for c in chosen for p in parts[c]}
        out.append((sum(1 << p for p in fixed), [p for p in free if p not in fixed]))
    return out


def links(fps: DataFrame, max_bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(a, b), a < b: every pair of distinct fingerprints at most ``max_bits``
    apart. Pairs meet in the buckets of a three-block key. A bucket of more
    than ``bucket_rows`` fingerprints is not joined as it is: its members agree
    on the key, so the bits that are left are cut into blocks again. After
    three cuts only 8 bits (at max_bits 3) are free: at most 256 members."""
    nodes = materialize(fps.select("fp").distinct(), "fingerprints")
    level = [(0, list(range(64)))]
    rows = nodes.select("fp", F.lit(0).alias("cut"))
    found = None
    while True:
        finer = [[(mask | more, free) for more, free in block_masks(left, max_bits)] for mask, left in level]
        masks = F.array(*[F.array(*[F.lit(_signed(m)) for m, _ in each]) for each in finer])
        width = len(finer[0])
        keyed = rows.select("fp", "cut", F.posexplode(masks[F.col("cut")]).alias("c", "mask")).select(
            "fp", (F.col("cut") * width + F.col("c")).alias("cut"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
        level = [x for each in finer for x in each]
        large = None
        if any(len(free) > 8 for _, free in level) and len(level) * width <= MASKS:
            large = materialize(keyed.groupBy("cut", "key").count().where(F.col("count") > bucket_rows).select("cut", "key"), "buckets")
            if large.isEmpty():
                large = None
        small = keyed.join(large, ["cut", "key"], "left_anti") if large is not None else keyed
        a, b = small.select("cut", "key", F.col("fp").alias("a")), small.select("cut", "key", F.col("fp").alias("b"))
        near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
        pairs = a.join(b, ["cut", "key"]).where((F.col("a") < F.col("b")) & near).select("a", "b")
        found = pairs if found is None else found.unionAll(pairs)
        if large is None:
            return found.distinct()
        rows = keyed.join(large, ["cut", "key"], "left_semi").select("fp", "cut")


def groups(fps: DataFrame, max_bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(fp, root, component_id): the smallest fingerprint and the smallest
    doc_id that are reachable. The root names the group; the component need
    not, as ids may be null or shared."""
    first = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "first")
    roots = connected(links(first, max_bits, bucket_rows))
    rooted = first.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_doc", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def _grouped(docs: DataFrame, shingle: int, max_bits: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    fps = materialize(fingerprints(docs, shingle, id_col, text_col), "simhash")
    return fps.join(groups(fps, max_bits), "fp", "left")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, fp, component_id), one row per row of ``docs``.

    Null, empty and blank texts have fingerprint 0 and link like any other;
    repeated rows stay repeated; a null id is never the smallest, and a group
    of null ids only has a null component. Other columns are not read.
    """
    return _grouped(docs, shingle, max_bits, id_col, text_col).select("doc_id", "text_key", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the smallest doc_id
    (null last), of rows with that id the smallest text key, of equal rows one.
    Extra columns may have any name."""
    best = _grouped(docs, shingle, max_bits).groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("text_key"))).alias("pick"))
    # Names by place: no column of the documents can clash.
    rows, names = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]), docs.columns
    doc_id, text = (F.col(f"c{names.index(c)}") for c in ("doc_id", "text"))
    chosen = best.select(F.col("pick.doc_id").alias("keep_id"), F.col("pick.text_key").alias("keep_key"))
    kept = rows.join(chosen, doc_id.eqNullSafe(F.col("keep_id")) & (text_key(text) == F.col("keep_key")))
    return kept.dropDuplicates(["keep_id", "keep_key"]).select([f"c{i}" for i in range(len(names))]).toDF(*names)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
