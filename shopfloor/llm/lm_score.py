"""LM scoring by cross-entropy difference (Moore-Lewis selection).

A target and a background bigram model are counted over the same vocabulary and
smoothed alike; the background's counts are scaled to the target's size, so
that equal text has equal loss under both. A text's score is its mean per-token
loss under the target less that under the background: the lower, the more it
reads like the target.

Words, contexts and pairs are counted each by itself, under 64-bit keys. Texts
are gathered into blocks; a block asks for each of its distinct keys once, with
its own counts. The keys' space is cut into buckets, whose number grows with the
text; a bucket adds up what all blocks hold and answers each block. No table of
counts is ever held whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ALNUM, LOWER, Chunk, chunks, materialize, mix64, read_table, spans_of, text_column

#: Weight of the word model in a pair's estimate, in tokens.
SMOOTHING = 20.0

#: Text and rows of a block (a longer text is a block of its own), and the text
#: whose keys one bucket adds up.
BLOCK_BYTES = 4 << 20
BLOCK_ROWS = 1 << 16
BUCKET_BYTES = 4 << 20

#: The low two bits of a key tell pairs (0), words and contexts apart.
_KIND = np.uint64(3)
_WORD, _CONTEXT = np.uint64(1), np.uint64(2)


def _ids(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word keys, keys of each word with the one before, whether there is one)."""
    hashes = chunk.word_hashes()
    inner = np.ones(len(hashes), dtype=bool)
    inner[chunk.first[:-1][chunk.first[:-1] < len(hashes)]] = False
    before = np.empty_like(hashes)
    before[1:] = hashes[:-1]
    before[~inner] = np.uint64(0)
    pair = mix64(before * np.uint64(0x9E3779B97F4A7C15) + hashes)
    return (hashes & ~_KIND) | _WORD, pair & ~_KIND, inner


def _pack(to: zstandard.ZstdCompressor, *columns: np.ndarray) -> bytes:
    """Columns of one length, byte plane by byte plane."""
    return to.compress(b"".join(np.ascontiguousarray(c.view(np.uint8).reshape(len(c), -1).T).tobytes() for c in columns))


def _unpack(by: zstandard.ZstdDecompressor, packed: bytes, *types: type) -> list[np.ndarray]:
    flat = np.frombuffer(by.decompress(packed), dtype=np.uint8)
    sizes = [np.dtype(t).itemsize for t in types]
    n, out, lo = len(flat) // sum(sizes), [], 0
    for t, size in zip(types, sizes):
        out.append(np.ascontiguousarray(flat[lo : lo + size * n].reshape(size, n).T).view(t)[:, 0])
        lo += size * n
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, target) gathered into blocks."""
    task, made = TaskContext.get().partitionId(), 0
    held: list[tuple[pa.Array, np.ndarray, np.ndarray, bytes]] = []

    def block() -> pa.RecordBatch:
        ids = pa.concat_arrays([h[0] for h in held])
        ends = pa.array([0, len(ids)], pa.int32())
        text = b"".join(h[3] for h in held)
        return pa.RecordBatch.from_arrays([
            pa.array([(task << 32) + made]), pa.ListArray.from_arrays(ends, ids),
            pa.ListArray.from_arrays(ends, pa.array(np.concatenate([h[1] for h in held]))),
            pa.ListArray.from_arrays(ends, pa.array(np.concatenate([h[2] for h in held]))),
            pa.array([zstandard.ZstdCompressor(level=1).compress(text)], pa.binary()), pa.array([len(text)], pa.int64()),
        ], ["block", "ids", "wanted", "lengths", "text", "bytes"])

    size = rows = 0
    for batch in batches:
        data, offsets = text_column(batch, "text")
        wanted = np.asarray(batch.column(2).fill_null(False).to_numpy(zero_copy_only=False), dtype=bool)
        for lo, hi in spans_of(offsets, BLOCK_BYTES // 8):
            more = int(offsets[hi] - offsets[lo])
            if held and (size + more > BLOCK_BYTES or rows + hi - lo > BLOCK_ROWS):
                yield block()
                held, made, size, rows = [], made + 1, 0, 0
            held.append((batch.column(0).slice(lo, hi - lo), wanted[lo:hi], np.diff(offsets[lo : hi + 1]), data[offsets[lo] : offsets[hi]].tobytes()))
            size, rows = size + more, rows + hi - lo
    if held:
        yield block()


class Block:
    """The words of a block's texts and its distinct keys. ``keys[word]`` are
    the words' keys, ``at`` the words that follow one of their text, ``pair``
    and ``context`` those words' keys of the pair and of the word before."""

    def __init__(self, text: bytes, lengths: np.ndarray):
        data = np.frombuffer(zstandard.ZstdDecompressor().decompress(text), dtype=np.uint8)
        offsets = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
        words, pairs, inners, sizes = [], [], [], []
        for lo, hi in spans_of(offsets):
            chunk = Chunk(lo, LOWER[data[offsets[lo] : offsets[hi]]], offsets[lo : hi + 1] - offsets[lo], ALNUM)
            for into, part in zip((words, pairs, inners), _ids(chunk)):
                into.append(part)
            sizes.append(np.diff(chunk.first))
        word, self.sizes = np.concatenate(words), np.concatenate(sizes)
        self.owner = np.repeat(np.arange(len(lengths)), self.sizes)
        self.at = np.flatnonzero(np.concatenate(inners))
        n, m = len(word), len(self.at)
        every = np.concatenate((word, np.concatenate(pairs)[self.at], (word[self.at - 1] & ~_KIND) | _CONTEXT))
        self.keys, place = np.unique(every, return_inverse=True)
        self.word, self.pair, self.context = place[:n], place[n : n + m], place[n + m :]

    def counts(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(target, total) of each key in the block; ``wanted`` by text."""
        place = np.concatenate((self.word, self.pair, self.context))
        mine = wanted[np.concatenate((self.owner, self.owner[self.at], self.owner[self.at]))]
        return np.bincount(place[mine], minlength=len(self.keys)), np.bincount(place, minlength=len(self.keys))

    def own(self, owner: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each entry's key occurs in its own text."""
        _, back, times = np.unique(owner * np.int64(len(self.keys)) + place, return_inverse=True, return_counts=True)
        return times[back].astype(np.float64)

    def losses(self, counts: list[np.ndarray], tokens: list[float], counted: list[np.ndarray], vocabulary: int) -> np.ndarray:
        """Summed negative log probabilities by model and text, each word after
        the one before it. A text that is ``counted`` in a model is judged by
        the rest of the corpus: its own counts are taken off."""
        owner, at = self.owner, self.at
        after = owner[at]
        own = self.own(owner, self.word), self.own(after, self.pair), self.own(after, self.context)
        out = np.zeros((len(counts), len(self.sizes)))
        for k, (held, size, share) in enumerate(zip(counts, tokens, counted)):
            off = share[owner]
            chance = (np.maximum(held[self.word] - off * own[0], 0) + 1) / (np.maximum(size - off * self.sizes[owner], 0) + vocabulary)
            context = np.maximum(held[self.context] - off[at] * own[2], 0)
            seen = np.minimum(np.maximum(held[self.pair] - off[at] * own[1], 0), context)
            chance[at] = (seen + SMOOTHING * chance[at]) / (context + SMOOTHING)
            out[k] = np.bincount(owner, weights=-np.log(chance), minlength=len(self.sizes))
        return out


def _list(column: pa.ListArray, row: int) -> np.ndarray:
    return column[row].values.to_numpy(zero_copy_only=False)


def _wanted(own: np.ndarray, marks: pa.Table) -> np.ndarray:
    """A block's target texts: its own flags and the places that marks add."""
    wanted = own.astype(bool)
    for places in marks.column("places"):
        wanted[places.values.to_numpy(zero_copy_only=False)] = True
    return wanted


def _asker(buckets: int):
    def run(left: pa.Table, marks: pa.Table) -> pa.Table:
        """Per block and bucket: the block's keys, as differences, and counts."""
        to = zstandard.ZstdCompressor(level=1)
        held = left.combine_chunks().to_batches()[0]
        block = Block(held.column(3)[0].as_py(), _list(held.column(2), 0))
        target, total = (c.astype(np.uint32) for c in block.counts(_wanted(_list(held.column(1), 0), marks)))
        # By the upper half, so that a bucket is a range of keys.
        bucket = ((block.keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        starts = np.flatnonzero(np.diff(bucket, prepend=-1))
        ends = np.append(starts[1:], len(bucket))
        asks = [_pack(to, np.diff(block.keys[lo:hi], prepend=np.uint64(0)), target[lo:hi], total[lo:hi]) for lo, hi in zip(starts, ends)]
        return pa.table([pa.array(np.full(len(asks), held.column(0)[0].as_py(), dtype=np.int64)), pa.array(bucket[starts], pa.int32()),
                         pa.array(asks, pa.binary())], names=["block", "bucket", "asks"])
    return run


def _answer(table: pa.Table) -> pa.Table:
    """One bucket's sums, answered to each block in the order of its keys; the
    first answer tells the bucket's words, tokens and target tokens."""
    to, by = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
    asks = [_unpack(by, a.as_py(), np.uint64, np.uint32, np.uint32) for a in table.column("asks")]
    lengths = [len(a[0]) for a in asks]
    keys, place = np.unique(np.concatenate([np.cumsum(a[0], dtype=np.uint64) for a in asks]), return_inverse=True)
    # Sums of doubles are exact up to 2^53.
    target, total = (np.bincount(place, weights=np.concatenate([a[k] for a in asks])).astype(np.uint64) for k in (1, 2))
    words = (keys & _KIND) == _WORD
    ends = np.cumsum(lengths)
    told = np.zeros((3, len(asks)), dtype=np.int64)
    told[:, 0] = np.count_nonzero(words), total[words].sum(), target[words].sum()
    packed = [_pack(to, target[place[hi - n : hi]], total[place[hi - n : hi]]) for n, hi in zip(lengths, ends)]
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "counts": pa.array(packed, pa.binary()),
                     "words": told[0], "tokens": told[1], "wanted": told[2]})


def places_of(blocks: DataFrame, ids: DataFrame) -> DataFrame:
    """(block, places): the texts whose id is one of ``ids`` (null ids match
    nothing). Only ids are joined, no text: a row per text, then per block."""
    listed = blocks.select("block", F.posexplode("ids").alias("place", "doc_id"))
    wanted = ids.select(F.col(ids.columns[0]).alias("doc_id")).where("doc_id is not null").distinct()
    return listed.join(wanted, "doc_id").groupBy("block").agg(F.collect_list("place").alias("places"))


def score(docs: DataFrame, is_target: Column, id_col: str = "doc_id", text_col: str = "text",
          target_ids: DataFrame | None = None) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, difference) per row of
    ``docs`` under models counted on ``docs``; ``is_target`` marks the rows of
    the target corpus (null: not), and so do their ids if they are in the only
    column of ``target_ids``; the background is every row. A text's own
    counts are left out where it is scored, as it would otherwise vouch for
    itself.

    Null, empty and wordless texts have no tokens and null losses. Repeated
    rows count each time and are scored each; ids may be null. With no target
    text both models are the background.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), is_target.alias("target"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    blocks = materialize(rows.mapInArrow(
        _blocks, f"block long, ids array<{id_type}>, wanted array<boolean>, lengths array<long>, text binary, bytes long"), "blocks")
    buckets = max(1, -(-(blocks.agg(F.sum("bytes")).first()[0] or 0) // BUCKET_BYTES))
    none = docs.sparkSession.createDataFrame([], "block long, places array<int>")
    marks = none if target_ids is None else materialize(places_of(blocks, target_ids), "marks")
    asks = blocks.select("block", "wanted", "lengths", "text").groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(
        _asker(buckets), "block long, bucket int, asks binary")
    answers = materialize(asks.groupBy("bucket").applyInArrow(
        _answer, "block long, bucket int, counts binary, words long, tokens long, wanted long"), "answers")
    words, tokens, wanted = (int(x or 0) for x in answers.agg(F.sum("words"), F.sum("tokens"), F.sum("wanted")).first())
    # The background has the target's number of tokens.
    vocabulary, scale = max(1, words), wanted / tokens if wanted else 1.0
    names = ["doc_id", "n_tokens", "target_loss", "background_loss", "difference"]

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        held = left.combine_chunks().to_batches()[0]
        block = Block(held.column(3)[0].as_py(), _list(held.column(2), 0))
        told = pa.compute.is_valid(right.column("places"))
        mine = _wanted(_list(held.column(1), 0), right.filter(told)).astype(np.float64)
        right = right.filter(pa.compute.invert(told))
        counts = np.zeros((2, 0))
        if right.num_rows:
            order = np.argsort(right.column("bucket").to_numpy())
            by = zstandard.ZstdDecompressor()
            counts = np.concatenate([_unpack(by, right.column("counts")[int(i)].as_py(), np.uint64, np.uint64) for i in order], axis=1).astype(np.float64)
        total, off = counts[1] * scale, np.full(len(mine), scale)
        losses = block.losses([counts[0] if wanted else total, total], [float(wanted or tokens), tokens * scale],
                              [mine if wanted else off, off], vocabulary)
        none = block.sizes == 0
        mean = losses / np.maximum(block.sizes, 1)
        return pa.table([held.column(4)[0].values, pa.array(block.sizes.astype(np.int64)),
                         *[pa.array(x, mask=none) for x in (mean[0], mean[1], mean[0] - mean[1])]], names=names)

    texts = blocks.select("block", "wanted", "lengths", "text", "ids")
    replies = answers.select("block", "bucket", "counts", F.lit(None).cast("array<int>").alias("places")).unionByName(
        marks.select("block", F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("binary").alias("counts"), "places"))
    return texts.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        judge, f"doc_id {id_type}, n_tokens long, target_loss double, background_loss double, difference double")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the texts labelled good and not toxic."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    good = read_table(spark, sf_dir, "labels").where("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id")
    return score(docs, F.lit(False), target_ids=good)
