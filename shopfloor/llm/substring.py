"""Exact removal of repeated word sequences by relative Lempel-Ziv parsing.

Every document is parsed against every other (and itself). Reference blocks
are cut by content: all windows of ``window`` words choose their smallest
word-gram hash as anchor, and a block is a stretch of windows with one anchor,
so equal passages are cut alike wherever they stand. The blocks are indexed by
anchor over the whole corpus with one aggregation. A document's parse walks
its own blocks from left to right; each is a factor:

* an anchor that occurs once has no reference: a literal;
* an anchor whose blocks are all equal is a long factor, found whole elsewhere:
  each of its windows repeats;
* an anchor with differing blocks marks a factor boundary: text that agrees
  only in part. There the windows are compared one by one, on the distinct
  blocks only, so thousands of copies cost as much as one.

Touching factors of repeated windows merge into duplicate spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import GRAM_BASE, NON_SPACE, Chunk, chunks, materialize, range_hash, read_table, sliding_min, text_column

WINDOW_WORDS = 35
GRAM_WORDS = 8

#: Windows in a block at most: their repeats are told by the bits of a long.
BLOCK_WINDOWS = 32

#: Bits of the filter that tells tasks which anchors have a reference. It has
#: this size for any input; where it fills up, more blocks are looked up.
FILTER_BITS = 1 << 26

BLOCK_BASE = 0xD1B54A32D192ED03


class Blocks:
    """The blocks of a chunk's documents: arrays with one entry per block."""

    def __init__(self, chunk: Chunk, window: int):
        gram = min(GRAM_WORDS, window)
        width = window - gram + 1
        words = chunk.word_hashes()
        n = len(words)
        at = np.arange(max(n - window + 1, 0))
        owner = chunk.text_of_word()
        at = at[chunk.first[owner[at] + 1] - at >= window]
        if not len(at):
            self.start = self.count = self.anchor = self.whole = self.twice = at.astype(np.int64)
            self.text, self.words = at, words
            return
        first = np.arange(n - gram + 1)
        grams = range_hash(words, first, first + gram, GRAM_BASE)
        least = sliding_min(grams, width)[at]
        fresh = np.empty(len(at), dtype=bool)
        fresh[0] = True
        fresh[1:] = (np.diff(at) != 1) | (least[1:] != least[:-1])
        head = np.flatnonzero(fresh)
        length = np.diff(np.append(head, len(at)))
        pieces = -(-length // BLOCK_WINDOWS)
        step = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = np.repeat(head, pieces) + step * BLOCK_WINDOWS
        self.count = np.minimum(np.repeat(length, pieces) - step * BLOCK_WINDOWS, BLOCK_WINDOWS)
        self.start = at[begin]
        self.anchor = least[begin]
        self.whole = range_hash(words, self.start, self.start + self.count + window - 1, BLOCK_BASE)
        # A window can only repeat inside its block if the anchor stands there twice.
        reach = np.arange(width)
        left = self.start + grams[self.start[:, None] + reach].argmin(axis=1)
        last = self.start + self.count - 1 + width - 1
        right = last - grams[last[:, None] - reach].argmin(axis=1)
        self.twice = left != right
        self.text, self.words, self.window = owner[self.start], words, window

    def windows(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window hashes of the chosen blocks, end to end, and their offsets."""
        count = self.count[rows]
        ends = np.cumsum(count)
        at = np.arange(count.sum()) - np.repeat(ends - count, count) + np.repeat(self.start[rows], count)
        return range_hash(self.words, at, at + self.window, GRAM_BASE), np.append(0, ends)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """Two longs that name a row by id and text; equal rows share them."""
    doc_id, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    return [F.xxhash64(doc_id, text).alias("k1"), F.xxhash64(F.lit("text"), text, text.isNull()).alias("k2")]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64), pa.int64())


def _index_rows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch, "text", NON_SPACE):
                b = Blocks(chunk, window)
                if len(b.start):
                    yield pa.RecordBatch.from_arrays(
                        [_signed(b.anchor), _signed(b.whole), pa.array(b.twice)], ["anchor", "whole", "twice"])
    return run


def _factor_rows(window: int, known, mixed):
    """Blocks whose anchor the index may know; with window hashes where its
    blocks may differ."""
    def has(bits: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        at = anchor.astype(np.uint64) & np.uint64(FILTER_BITS - 1)
        return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch, "text", NON_SPACE):
                b = Blocks(chunk, window)
                if not len(b.start):
                    continue
                rows = np.flatnonzero(has(known.value, b.anchor))
                parted = has(mixed.value, b.anchor[rows])
                text = pa.array(b.text[rows] + chunk.lo)
                hashes, ends = b.windows(rows[parted])
                offsets = np.zeros(len(rows) + 1, dtype=np.int64)
                offsets[1:][parted] = np.diff(ends)
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum(offsets), pa.int32()), _signed(hashes), mask=pa.array(~parted))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(text), batch.column(1).take(text),
                     pa.array(b.start[rows] - chunk.first[b.text[rows]], pa.int64()), pa.array(b.count[rows], pa.int32()),
                     _signed(b.anchor[rows]), _signed(b.whole[rows]), lists],
                    ["k1", "k2", "start", "count", "anchor", "whole", "hashes"])
    return run


def _filter(anchors: DataFrame):
    """A broadcast bitmap of FILTER_BITS bits with those of the anchors set."""
    spot = F.col("anchor").bitwiseAND(FILTER_BITS - 1) + 1
    parts = anchors.select(spot.alias("spot")).groupBy(F.bitmap_bucket_number("spot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits"))
    bits = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for row in parts.toLocalIterator():
        part = np.frombuffer(row.bits, dtype=np.uint8)
        at = (row.bucket - 1) * 4096
        bits[at : at + len(part)] = part[: len(bits) - at]
    return anchors.sparkSession.sparkContext.broadcast(bits)


def repeated_windows(docs: DataFrame, window: int = WINDOW_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(k1, k2, blocks): per row that holds a repeated window, its blocks as
    structs of start word, windows and the bits of those that repeat."""
    keys = _keyed(docs, id_col, text_col)
    text = F.col(f"`{text_col}`").alias("text")
    index = docs.select(text).mapInArrow(_index_rows(window), "anchor long, whole long, twice boolean")
    index = index.groupBy("anchor").agg(
        F.count("*").alias("places"), F.min("whole").alias("whole"), F.max("whole").alias("other"), F.max("twice").alias("twice"))
    alike = (F.col("whole") == F.col("other")) & ~F.col("twice")
    index = materialize(index.where((F.col("places") > 1) | F.col("twice")).select("anchor", "whole", alike.alias("alike")), "index")

    known, mixed = _filter(index), _filter(index.where("not alike"))
    factors = materialize(docs.select(*keys, text).mapInArrow(
        _factor_rows(window, known, mixed),
        "k1 long, k2 long, start long, count int, anchor long, whole long, hashes array<long>"), "factors")

    blocks = factors.where("hashes is not null").groupBy("anchor", "whole").agg(
        F.count("*").alias("places"), F.first("hashes").alias("hashes"))
    blocks = materialize(blocks, "boundary")
    each = blocks.select("anchor", "whole", "places", F.posexplode("hashes").alias("at", "hash"))
    again = each.groupBy("anchor", "hash").agg(F.sum("places").alias("places")).where("places > 1").select("anchor", "hash")
    parted = each.join(again, ["anchor", "hash"]).groupBy("anchor", "whole").agg(
        F.bit_or(F.expr("shiftleft(1L, at)")).alias("bits"))
    found = index.where("alike").select("anchor", "whole", F.lit(-1).cast("long").alias("bits")).unionAll(
        parted.select("anchor", "whole", "bits"))
    hits = factors.select("k1", "k2", "start", "count", "anchor", "whole").join(found, ["anchor", "whole"])
    # Rows equal in id and text give the same blocks: a set holds each once, however many rows there are.
    return hits.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "count", "bits")).alias("blocks"))


def _cover(n: int, blocks: list[dict], window: int) -> np.ndarray:
    """Which of n words a repeated window covers."""
    depth = np.zeros(n + 1, dtype=np.int64)
    for b in blocks:
        bits = b["bits"] & ((1 << b["count"]) - 1)
        at = np.flatnonzero([bits >> i & 1 for i in range(b["count"])]) + b["start"]
        np.add.at(depth, at, 1)
        np.add.at(depth, at + window, -1)
    return np.cumsum(depth[:-1]) > 0


def _cut_rows(window: int, text_at: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, spans, kept = [], [], [], []
            data, offsets = text_column(batch, batch.schema.names[text_at])
            lists = batch.column(batch.num_columns - 1)
            for i in range(batch.num_rows):
                words = data[offsets[i] : offsets[i + 1]].tobytes().split()
                n_words.append(len(words))
                blocks = lists[i].as_py()
                if not blocks:
                    n_removed.append(0)
                    spans.append([])
                    kept.append(b" ".join(words))
                    continue
                gone = _cover(len(words), blocks, window)
                edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                n_removed.append(int(gone.sum()))
                spans.append([{"start": int(a), "n": int(b - a)} for a, b in zip(edge[::2], edge[1::2])])
                kept.append(b" ".join([w for w, g in zip(words, gone.tolist()) if not g]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("n", pa.int64())]))),
                 pa.array(kept, pa.binary()).cast(pa.string())], names)
    return run


def cut_repeats(docs: DataFrame, window: int = WINDOW_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every column of ``docs`` by position (c0, c1, ...) and n_words,
    n_removed, spans (start word and words of each duplicate span, merged) and
    kept_text: the words no repeated window covers, joined by single spaces.

    Null, empty and blank texts have no words and an empty kept_text. Rows
    equal in id and text are occurrences of their own, so they remove each
    other's windows. Ids may be null.
    """
    lists = repeated_windows(docs, window, id_col, text_col)
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)], *_keyed(docs, id_col, text_col))
    rows = rows.join(lists, ["k1", "k2"], "left").select(*names, "blocks")
    schema = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)
    out = [*names, "n_words", "n_removed", "spans", "kept_text"]
    return rows.mapInArrow(
        _cut_rows(window, docs.columns.index(text_col), out),
        f"{schema}, n_words long, n_removed long, spans array<struct<start: bigint, n: bigint>>, kept_text string")


def cut_texts(docs: DataFrame, window: int = WINDOW_WORDS, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with repeated windows cut out. A text that holds none stays as
    it is, byte for byte; of the others the kept words are joined by single
    spaces, ``chars_col`` (if there is one) is set anew, and rows of which no
    word is kept go."""
    cut = cut_repeats(docs, window, "doc_id", text_col)
    changed = F.col("n_removed") > 0
    columns = []
    for i, c in enumerate(docs.columns):
        own = F.col(f"c{i}")
        if c == text_col:
            own = F.when(changed, F.col("kept_text")).otherwise(own)
        elif c == chars_col:
            own = F.when(changed, F.length("kept_text").cast(docs.schema[c].dataType)).otherwise(own)
        columns.append(own.alias(c))
    return cut.where("n_removed = 0 or n_removed < n_words").select(*columns)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = cut_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(F.col("c0").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


#: Words are numbered per document; a window is the list of its words.
OP5_SQL = """
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35),
h AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) AS m FROM p),
r AS (SELECT doc_id, i FROM h WHERE m IN (SELECT m FROM h GROUP BY m HAVING count(*) > 1)),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM r),
gl AS (SELECT doc_id, list(i) AS gone FROM g GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(coalesce(array_to_string(list_filter(ws, lambda x, i: NOT coalesce(list_contains(gone, i), false)), ' '), '')) AS kept_sha256
FROM w LEFT JOIN gl USING (doc_id)
"""
