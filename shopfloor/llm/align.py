"""Tokens of one tokenizer aligned with those of another, by divide and conquer
at shared cuts: near the middle of an interval a byte offset is located, by
bisect, where a token of either side ends; both halves are treated alike, and an
interval without such an offset is one group of tokens. All intervals of a block
of texts advance together. Two tokens whose bytes overlap are linked; how many
documents link two ids is counted over the whole corpus.

A: byte-level BPE (a tokenizers JSON file) of a space and the text. B: a
SentencePiece model of the text, to which it adds the space.

Null and empty texts, and texts of which the joined tokens of a side are not the
space and the text, have no tokens: no groups, no links, zeros. Repeated rows
are documents of their own, in the result and in the counts; ids may be null and
are only passed through. An empty table gives an empty result. Other columns are
not read. A task's memory grows with its longest text, which is aligned whole.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, read_table, spans_of, text_column

A_PATH = "/opt/tokenizers/byte_bpe_50k.json"
B_PATH = "/opt/tokenizers/piece_bpe_32k.model"

#: Bytes of text in a block: each asks once for the counts of the pairs it holds.
BLOCK_BYTES = 2 << 20

#: How byte-level BPE cuts a text into words (the rule that ByteLevel with use_regex stands for).
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the
    others, in order, as the letters from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in printable]
    return {**{chr(b): b for b in printable}, **{chr(256 + i): b for i, b in enumerate(other)}}


class ByteLevel:
    """Side A. Where the file's merges are in the order of the ids they make,
    and nothing but the byte-level rule comes before them, ranks say the same as
    merges, and the tiktoken library gives the same ids several times faster;
    any other file is left to the tokenizers library."""

    def __init__(self, text: str):
        self.text = text
        spec = json.loads(text)
        letters, vocabulary = byte_of_letter(), spec["model"]["vocab"]
        special = {t["id"] for t in spec.get("added_tokens", [])}
        size = max([*vocabulary.values(), *special]) + 1
        self.bytes = [b""] * size
        for token, i in vocabulary.items():
            self.bytes[i] = token.encode() if i in special else bytes(letters[c] for c in token)
        for token in spec.get("added_tokens", []):
            self.bytes[token["id"]] = token["content"].encode()
        self.plain = self._by_rank(spec, special)
        if self.plain:
            ranks = {b: i for i, b in enumerate(self.bytes) if i not in special}
            self.encoder = tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens={})
        else:
            self.encoder = tokenizers.Tokenizer.from_str(text)
            self.encoder.encode_special_tokens = True

    @staticmethod
    def _by_rank(spec: dict, special: set[int]) -> bool:
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        if model.get("type") != "BPE" or spec.get("normalizer") or any(
                model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
            return False
        if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
            return False
        if not all(t["special"] for t in spec.get("added_tokens", [])):
            return False
        made = [model["vocab"].get("".join(m.split(" ") if isinstance(m, str) else m), -1) for m in model["merges"]]
        singles = {i for t, i in model["vocab"].items() if len(t) == 1}
        every = singles | set(made) | special
        return made == sorted(set(made)) and len(singles) == 256 and every == set(model["vocab"].values()) | special

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.plain:
            return [self.encoder.encode_to_numpy(t, disallowed_special=()) for t in texts]
        return [np.array(e.ids, dtype=np.uint32) for e in self.encoder.encode_batch(texts, add_special_tokens=False)]


class Pieces:
    """Side B."""

    def __init__(self, model: bytes):
        self.encoder = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.encoder.get_piece_size()
        self.bytes = [bytes([int(self.encoder.id_to_piece(i)[3:-1], 16)]) if self.encoder.is_byte(i)
                      else self.encoder.id_to_piece(i).replace("▁", " ").encode() for i in range(n)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, dtype=np.uint32) for ids in self.encoder.encode(texts, num_threads=1)]


@dataclass
class Files:
    """The two vocabulary files, read on the driver and broadcast; their size is
    that of the vocabularies."""

    a: str
    b: bytes

    @classmethod
    def read(cls, a_path: str = A_PATH, b_path: str = B_PATH) -> Files:
        with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
            return cls(a.read(), b.read())


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group ends, as counts of A and of B tokens before them. Text t has the
    tokens ``first[t]:first[t + 1]``; both sides of a text end at one byte.

    Each interval is a range of tokens of either side that covers the same
    bytes. From its middle token of A, ends are probed outwards until B, by
    bisect, has the same one; there the interval is cut."""
    ends_a, ends_b = ends_a.astype(np.int32), ends_b.astype(np.int32)
    some = first_a[1:] > first_a[:-1]
    spans = [x[some].astype(np.int32) for x in (first_a[:-1], first_a[1:], first_b[:-1], first_b[1:])]
    done_a, done_b = [np.zeros(0, dtype=np.int32)], [np.zeros(0, dtype=np.int32)]
    while len(spans[0]):
        a_lo, a_hi, b_lo, b_hi = spans
        single = (a_hi - a_lo == 1) | (b_hi - b_lo == 1)
        done_a.append(a_hi[single])
        done_b.append(b_hi[single])
        a_lo, a_hi, b_lo, b_hi = (x[~single] for x in spans)
        probe = (a_lo + a_hi - 2) >> 1
        cut_a = probe + 1
        cut_b, hit = _bisect(ends_b, ends_a[probe])
        seeking = np.flatnonzero(~hit)
        middle, lo, last = probe[seeking], a_lo[seeking], a_hi[seeking] - 2
        step = 0
        while len(seeking):
            step += 1
            for side in (step, -step):
                probe = np.clip(middle + side, lo, last)
                met, same = _bisect(ends_b, ends_a[probe])
                where = seeking[same]
                cut_a[where], cut_b[where], hit[where] = probe[same] + 1, met[same], True
                rest = ~same
                seeking, middle, lo, last = seeking[rest], middle[rest], lo[rest], last[rest]
            rest = (middle - lo > step) | (last - middle > step)
            seeking, middle, lo, last = seeking[rest], middle[rest], lo[rest], last[rest]
        done_a.append(a_hi[~hit])
        done_b.append(b_hi[~hit])
        a_lo, a_hi, b_lo, b_hi, cut_a, cut_b = (x[hit] for x in (a_lo, a_hi, b_lo, b_hi, cut_a, cut_b))
        spans = [np.concatenate(x) for x in ((a_lo, cut_a), (cut_a, a_hi), (b_lo, cut_b), (cut_b, b_hi))]
    return np.sort(np.concatenate(done_a)).astype(np.int64), np.sort(np.concatenate(done_b)).astype(np.int64)


def _bisect(ends: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens end up to each offset, and whether one ends there."""
    at = np.searchsorted(ends, offsets).astype(np.int32)
    return at + np.int32(1), ends[at] == offsets


class Block:
    """Some texts with their tokens, groups and links. ``first_a[t]`` is the
    first token of text t, ``first_group[t]`` its first group; ``link_a`` and
    ``link_b`` are the ids of each pair that overlaps, ``first_link[t]`` text t's first."""

    def __init__(self, ids_a: list[np.ndarray], ids_b: list[np.ndarray], sizes_a: np.ndarray, sizes_b: np.ndarray):
        count = lambda ids: np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int64)
        flat = lambda ids: np.concatenate([np.zeros(0, dtype=np.int64), *ids]).astype(np.int64)
        self.first_a, self.first_b = count(ids_a), count(ids_b)
        self.a, self.b = flat(ids_a), flat(ids_b)
        self.ends_a, self.ends_b = np.cumsum(sizes_a[self.a]), np.cumsum(sizes_b[self.b])
        self.group_a, self.group_b = shared_cuts(self.ends_a, self.ends_b, self.first_a, self.first_b)
        self.first_group = np.searchsorted(self.group_a, self.first_a, side="right")

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first_link, ids of A, ids of B): tokens overlap in exactly one
        stretch between two neighbouring ends of either side."""
        size = int(self.ends_a[-1]) if len(self.ends_a) else 0
        in_a, in_b = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
        in_a[self.ends_a - 1] = True
        in_b[self.ends_b - 1] = True
        stop = np.flatnonzero(in_a | in_b)
        end_of_text = np.concatenate(([0], self.ends_a))[self.first_a]
        a = (np.cumsum(in_a) - in_a)[stop]
        b = (np.cumsum(in_b) - in_b)[stop]
        return np.searchsorted(stop, end_of_text), self.a[a], self.b[b]

    def group_lists(self) -> tuple[list, list]:
        """Per text its groups: lists of the ids of A and of B."""
        cut = lambda ids, ends, lo, hi: [ids[x:y].tolist() for x, y in zip(np.concatenate(([lo], ends[:-1])), ends)] if hi > lo else []
        parts = [slice(x, y) for x, y in zip(self.first_group[:-1], self.first_group[1:])]
        return ([cut(self.a, self.group_a[p], x, y) for p, x, y in zip(parts, self.first_a[:-1], self.first_a[1:])],
                [cut(self.b, self.group_b[p], x, y) for p, x, y in zip(parts, self.first_b[:-1], self.first_b[1:])])


class Aligner:
    """Encodes and aligns texts on an executor."""

    def __init__(self, files: Files):
        self.side_a, self.side_b = ByteLevel(files.a), Pieces(files.b)
        self.sizes_a = np.array([len(b) for b in self.side_a.bytes], dtype=np.int64)
        self.sizes_b = np.array([len(b) for b in self.side_b.bytes], dtype=np.int64)
        self.table_a, self.table_b = pa.array(self.side_a.bytes, pa.large_binary()), pa.array(self.side_b.bytes, pa.large_binary())
        # Every way in which an id is written in a list of groups: inside one, and at the end of its A or B ids.
        numbers = lambda n, end: [f"{i}{end}" for i in range(n)]
        na, nb = len(self.side_a.bytes), len(self.side_b.bytes)
        self.written = pa.array(numbers(na, ",") + numbers(na, "|") + numbers(nb, ",") + numbers(nb, ";"), pa.large_string())

    def align(self, texts: list[bytes]) -> Block:
        spaced = [b" " + t for t in texts]
        held = [t.decode() for t in texts]
        ids_a = self.side_a.encode([" " + t if t else "" for t in held])
        ids_b = self.side_b.encode(held)
        none = np.zeros(0, dtype=np.uint32)
        for t, text in enumerate(texts):
            if not text or self._joined(self.table_a, self.sizes_a, ids_a[t]) != spaced[t] or self._joined(self.table_b, self.sizes_b, ids_b[t]) != spaced[t]:
                ids_a[t] = ids_b[t] = none
        return Block(ids_a, ids_b, self.sizes_a, self.sizes_b)

    @staticmethod
    def _joined(table: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> bytes:
        if not len(ids):
            return b""
        return table.take(pa.array(ids)).buffers()[2].to_pybytes()[: int(sizes[ids].sum())]

    def digests(self, block: Block) -> list[str]:
        """SHA-256 of each text's groups as ``a1,a2|b1;a3|b2,b3``; '' for none."""
        na, nb = len(self.sizes_a), len(self.sizes_b)
        last_a, last_b = np.zeros(len(block.a), dtype=np.int64), np.zeros(len(block.b), dtype=np.int64)
        last_a[block.group_a - 1] = na
        last_b[block.group_b - 1] = nb
        group_of_a = np.cumsum(last_a > 0) - (last_a > 0)
        group_of_b = np.cumsum(last_b > 0) - (last_b > 0)
        order = np.empty(len(block.a) + len(block.b), dtype=np.int64)
        before_b = np.concatenate(([0], block.group_b))
        order[np.arange(len(block.a)) + before_b[group_of_a]] = block.a + last_a
        order[np.arange(len(block.b)) + block.group_a[group_of_b]] = 2 * na + block.b + last_b
        if not len(order):
            return [""] * (len(block.first_a) - 1)
        written = self.written.take(pa.array(order))
        offsets = np.frombuffer(written.buffers()[1], dtype=np.int64)
        data = memoryview(written.buffers()[2])
        bounds = offsets[block.first_a + block.first_b]
        return [hashlib.sha256(data[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(bounds[:-1], bounds[1:])]


def _blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        data, offsets = text_column(batch, "text")
        for lo, hi in spans_of(offsets, block_bytes):
            yield batch.slice(lo, hi - lo), [data[x:y].tobytes() for x, y in zip(offsets[lo:hi], offsets[lo + 1 : hi + 1])]


def _rows(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return rows, rows.schema["doc_id"].dataType.simpleString()


def groups(docs: DataFrame, files: Files, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, a_groups, b_groups): for each document the ids of either side, group by group."""
    rows, id_type = _rows(docs, id_col, text_col)
    held = docs.sparkSession.sparkContext.broadcast(vars(files))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(Files(**held.value))
        for batch, texts in _blocks(batches, block_bytes):
            a, b = aligner.align(texts).group_lists()
            ids = pa.list_(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(a, ids), pa.array(b, ids)], ["doc_id", "a_groups", "b_groups"])

    return rows.mapInArrow(run, f"doc_id {id_type}, a_groups array<array<int>>, b_groups array<array<int>>")


def aligned(docs: DataFrame, files: Files, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One table with two kinds of rows, both with the number of their block:

    * a row per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256 and
      ``held``, its pairs as places in the block's sorted list, and how often it
      holds each;
    * a row per pair of ids (A's in the upper 32 bits) that the block holds, and
      how many of its documents hold it.
    """
    rows, id_type = _rows(docs, id_col, text_col)
    held = docs.sparkSession.sparkContext.broadcast(vars(files))
    schema = f"block long, doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, held binary, pair long, docs long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(Files(**held.value))
        number = TaskContext.get().partitionId() << 32
        pack = zstandard.ZstdCompressor(level=1)
        for batch, texts in _blocks(batches, block_bytes):
            block = aligner.align(texts)
            first, a, b = block.links()
            pairs, place = np.unique((a << 32) | b, return_inverse=True)
            n = len(texts)
            owner = np.repeat(np.arange(n), np.diff(first))
            mine, times = np.unique(owner * max(len(pairs), 1) + place, return_counts=True)
            owner, place = np.divmod(mine, max(len(pairs), 1))
            bounds = np.searchsorted(owner, np.arange(n + 1))
            docs_with = np.bincount(place, minlength=len(pairs))
            step = np.diff(place, prepend=0)
            packed = [pack.compress(np.concatenate(([place[x]], step[x + 1 : y], times[x:y])).astype(np.int32).tobytes()) if y > x else None
                      for x, y in zip(bounds[:-1], bounds[1:])]
            tell = [np.diff(block.first_a), np.diff(block.first_b), np.diff(block.first_group), np.diff(first)]
            names = [f.split(" ")[0] for f in schema.split(", ")]
            empty = lambda k, kind: pa.nulls(k, kind)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(n, number)), batch.column(0), *[pa.array(c, pa.int64()) for c in tell], pa.array(aligner.digests(block), pa.string()),
                pa.array(packed, pa.binary()), empty(n, pa.int64()), empty(n, pa.int64())], names)
            if len(pairs):
                k = len(pairs)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(k, number)), empty(k, batch.column(0).type), *[empty(k, pa.int64())] * 4, empty(k, pa.string()), empty(k, pa.binary()),
                    pa.array(pairs), pa.array(docs_with, pa.int64())], names)
            number += 1

    return rows.mapInArrow(run, schema)


def pair_counts(table: DataFrame) -> DataFrame:
    """(pair, count, best): in how many documents of the corpus two ids are
    linked, and whether no id of B is linked with that id of A in more."""
    counts = table.where("pair is not null").groupBy("pair").agg(F.sum("docs").alias("count"))
    a = F.shiftright("pair", 32)
    highest = counts.groupBy(a.alias("a")).agg(F.max("count").alias("highest"))
    return counts.withColumn("a", a).join(highest, "a").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def link_scores(docs: DataFrame, files: Files, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum),
    one row per row of ``docs``. Blocks ask for the counts of their pairs by one
    join on the pair; the answers meet the block's documents by its number."""
    table = materialize(aligned(docs, files, id_col, text_col, block_bytes), "aligned")
    asked = table.where("pair is not null").select(F.col("block").alias("asks"), "pair")
    answers = asked.join(materialize(pair_counts(table), "pair-counts"), "pair").select("asks", "pair", "count", "best")
    each = table.where("pair is null").drop("pair", "docs")
    out = [c for c in each.columns if c not in ("block", "held")]
    id_type = each.schema["doc_id"].dataType.simpleString()

    def score(texts: pa.Table, known: pa.Table) -> pa.Table:
        order = np.argsort(known.column("pair").to_numpy())
        count = known.column("count").to_numpy()[order]
        best = known.column("best").to_numpy()[order]
        unpack = zstandard.ZstdDecompressor()
        n_best, total = [], []
        for packed in texts.column("held"):
            found = np.frombuffer(unpack.decompress(packed.as_py()) if packed.is_valid else b"", dtype=np.int32).astype(np.int64)
            place, times = np.cumsum(found[: len(found) // 2]), found[len(found) // 2 :]
            n_best.append(int(times[best[place]].sum()))
            total.append(int((times * count[place]).sum()))
        return pa.table([*[texts.column(c) for c in out], pa.array(n_best, pa.int64()), pa.array(total, pa.int64())], names=[*out, "n_best", "count_sum"])

    return each.groupBy("block").cogroup(answers.groupBy("asks")).applyInArrow(
        score, f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_scores(read_table(spark, sf_dir, "documents"), Files.read())
