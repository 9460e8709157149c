"""SentencePiece encoding and decoding with a batched numpy Viterbi.

A text becomes words, each with the white space before it; a word's pieces do
not depend on its neighbours. Distinct words of one length advance together:
at every end position all substrings are hashed, a small bitmap and then the
sorted piece keys are probed, each piece that fits offers a path, and the best
path's piece is the backpointer (an argmax over the piece lengths).

For unigram models the value of a path is its summed score. A BPE model has no
path score: its text is merged pair by pair in order of rank. There, a piece
continues the path before it only if merging the two alone would leave their
border uncut, which holds for exactly one piece at every position; so the same
walk returns what the merges return, in time linear in the word.
"""

from __future__ import annotations

import codecs
import heapq
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mix64, read_table

#: The vocabulary file of op4 and of the pipeline; any reader may pass another.
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"

SPACE = "▁"

#: Bits of the bitmap that keeps most substrings from the search of the keys.
BITMAP_BITS = 1 << 20

#: Slots of the table that remembers pairs of pieces (BPE).
PAIR_SLOTS = 1 << 21

#: Words remembered by a task, and the longest that is.
CACHE_WORDS = 400_000
CACHE_CHARS = 64

#: Words and characters that advance together.
ROWS = 8192
CELLS = 1 << 18

CHAR_BASE = 0x8CB92BA72F3D8DD7
NO_RANK = 1 << 30


@dataclass
class Vocabulary:
    """Pieces by id, with scores; ``kind`` is "unigram" or "bpe"."""

    pieces: list[str]
    scores: list[float]
    kind: str
    unknown: int
    controls: set[int] = field(default_factory=set)
    bytes_at: dict[int, int] = field(default_factory=dict)
    dummy_prefix: bool = True

    @classmethod
    def load(cls, path: str, kind: str = "bpe") -> Vocabulary:
        """From a SentencePiece model file with identity normalisation."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        pieces = [model.id_to_piece(i) for i in ids]
        return cls(
            pieces, [model.get_score(i) for i in ids], kind, model.unk_id(),
            {i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)},
            {int(pieces[i][3:5], 16): i for i in ids if model.is_byte(i)})

    def plain(self) -> list[int]:
        """Ids that stand for their own text."""
        held = set(self.bytes_at.values()) | self.controls
        return [i for i in range(len(self.pieces)) if i not in held]


def merged(symbols: str, rank: dict[str, float]) -> list[str]:
    """BPE by definition: the adjacent pair whose union is the best-ranked
    piece is merged, the leftmost of equals first, until none is a piece."""
    parts: list[str | None] = list(symbols)
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap: list[tuple[float, int, str]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < len(parts) and (r := rank.get(both := parts[i] + parts[after[i]])) is not None:
            heapq.heappush(heap, (r, i, both))

    for i in range(len(parts) - 1):
        offer(i)
    while heap:
        _, i, both = heapq.heappop(heap)
        j = after[i] if parts[i] is not None else len(parts)
        if j >= len(parts) or parts[i] + parts[j] != both:
            continue
        parts[i], parts[j] = both, None
        after[i] = after[j]
        if after[j] < len(parts):
            before[after[j]] = i
        offer(before[i])
        offer(i)
    return [p for p in parts if p is not None]


#: A hash is the sum of (character + 1) * base ** place, places from 1, modulo
#: 2**64; its upper bits depend on every character.
BITMAP_SHIFT = np.uint64(64 - BITMAP_BITS.bit_length() + 1)


class Encoder:
    """Words to ids. Ids beyond the vocabulary stand for characters outside it."""

    def __init__(self, vocabulary: Vocabulary):
        v = self.vocabulary = vocabulary
        plain = v.plain()
        self.longest = max([len(v.pieces[i]) for i in plain], default=1)
        self.rank_of = {v.pieces[i]: -v.scores[i] for i in plain if len(v.pieces[i]) > 1}
        #: White space inside a piece: then words are not apart, and a text is one word.
        self.apart = not any(SPACE in v.pieces[i].lstrip(SPACE) for i in plain)
        self.slots = np.zeros(PAIR_SLOTS, dtype=np.int64)
        self.splitter = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if self.apart else r"(?s).+")
        if v.kind == "bpe":
            self._pair_tables(plain)
            plain = [i for i in plain if self.reached[i]]
        up = np.ones(self.longest + 1, dtype=np.uint64)
        up[1:] = np.multiply.accumulate(np.full(self.longest, CHAR_BASE, dtype=np.uint64))
        keys = np.array([self._key(v.pieces[i], up) for i in plain], dtype=np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(plain, dtype=np.int64)[order]
        assert len(np.unique(self.keys)) == len(self.keys), "two pieces share a hash"
        self.scores = np.array(v.scores)
        self.bitmap = np.zeros(BITMAP_BITS, dtype=bool)
        slot = (self.keys >> BITMAP_SHIFT).astype(np.int64)
        self.bitmap[slot] = True
        #: Where the sorted keys with given upper bits begin, and how many share them.
        self.begin = np.searchsorted(slot, np.arange(BITMAP_BITS)).astype(np.int32)
        self.most = int(np.bincount(slot).max(initial=1))
        #: An unknown character costs more than any piece.
        self.unknown_score = min(v.scores, default=0.0) - 10.0

    def state(self) -> tuple[dict, dict]:
        """What :meth:`of` needs: broadcasts carry plain values and arrays."""
        return vars(self.vocabulary), {k: x for k, x in vars(self).items() if k not in ("vocabulary", "slots")}

    @classmethod
    def of(cls, state: tuple[dict, dict]) -> Encoder:
        out = cls.__new__(cls)
        out.vocabulary = Vocabulary(**state[0])
        out.__dict__.update(state[1])
        out.slots = np.zeros(PAIR_SLOTS, dtype=np.int64)
        return out

    @staticmethod
    def _key(piece: str, up: np.ndarray) -> int:
        codes = np.array([ord(c) + 1 for c in piece], dtype=np.uint64)
        return int((codes * up[1 : len(codes) + 1]).sum())

    # --- BPE: which pieces can stand side by side

    def _pair_tables(self, plain: list[int]) -> None:
        v = self.vocabulary
        at = self.id_of = {v.pieces[i]: i for i in plain}
        n = len(v.pieces) + 1  # the last stands for any character outside the vocabulary
        self.reached = np.zeros(n, dtype=bool)
        self.rank = np.full(n, -1, dtype=np.int64)
        self.left, self.right = np.arange(n), np.arange(n)
        order = sorted({r for r in self.rank_of.values()})
        step = {r: k for k, r in enumerate(order)}
        pairs = {}
        for piece in (v.pieces[i] for i in plain):
            i = at[piece]
            if len(piece) == 1:
                self.reached[i] = True
                continue
            self.rank[i] = step[self.rank_of[piece]]
            for cut in range(1, len(piece)):
                a, b = at.get(piece[:cut]), at.get(piece[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = self.rank[i]
            parts = self._last_merge(piece)
            if parts is not None and parts[0] in at and parts[1] in at:
                self.reached[i] = True
                self.left[i], self.right[i] = at[parts[0]], at[parts[1]]
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_rank = np.array([pairs[k] for k in sorted(pairs)], dtype=np.int64)
        #: Pieces that share a rank are merged by place, which pairs do not tell.
        times = Counter(self.rank_of.values())
        self.tied = [p for p, r in self.rank_of.items() if times[r] > 1]

    def _last_merge(self, piece: str) -> tuple[str, str] | None:
        """The two parts that the merges of a piece's own text join last."""
        parts = list(piece)
        while len(parts) > 1:
            ranks = [self.rank_of.get(a + b) for a, b in zip(parts, parts[1:])]
            known = [(r, k) for k, r in enumerate(ranks) if r is not None]
            if not known:
                return None
            k = min(known)[1]
            if len(parts) == 2:
                return parts[0], parts[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return None

    def _pair_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        spot = np.minimum(np.searchsorted(self.pair_keys, key), max(len(self.pair_keys) - 1, 0))
        if not len(self.pair_keys):
            return np.full(len(a), NO_RANK)
        return np.where(self.pair_keys[spot] == key, self.pair_rank[spot], NO_RANK)

    def _uncut(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging a's and b's text together leaves both as they are:
        their merges are undone from the last to the first, and at no stage may
        the pair across the border have been the better merge."""
        out = np.ones(len(a), dtype=bool)
        open_, limit = np.arange(len(a)), np.full(len(a), NO_RANK)
        a, b = a.copy(), b.copy()
        while len(open_):
            crossed = self._pair_of(a, b) < limit
            out[open_[crossed]] = False
            ra, rb = self.rank[a], self.rank[b]
            more = ~crossed & ((ra >= 0) | (rb >= 0))
            open_, a, b, ra, rb, limit = open_[more], a[more], b[more], ra[more], rb[more], limit[more]
            first = ra > rb
            limit = np.where(first, ra, rb + 1)
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
        return out

    def _joins(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """_uncut, remembered: a slot holds the pair and its answer."""
        pair = (a << 32 | b) + 1
        slot = (mix64(pair.astype(np.uint64)) & np.uint64(PAIR_SLOTS - 1)).astype(np.int64)
        found = self.slots[slot]
        known = found >> 1 == pair
        out = (found & 1) == 1
        new = np.flatnonzero(~known)
        if len(new):
            _, one, back = np.unique(pair[new], return_index=True, return_inverse=True)
            answer = self._uncut(a[new[one]], b[new[one]])
            out[new] = answer[back]
            self.slots[slot[new[one]]] = pair[new[one]] << 1 | answer
        return out

    # --- the walk

    def _probe(self, some: np.ndarray, key: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows whose substring is a piece, and the piece."""
        first = self.begin[slot]
        spot = first.copy()
        for more in range(1, self.most):
            spot = np.where(self.keys[spot] < key, np.minimum(first + more, len(self.keys) - 1), spot)
        hit = self.keys[spot] == key
        return some[hit], self.ids[spot[hit]]

    def _walk(self, words: list[str]) -> list[bytes]:
        """Ids of words of one length."""
        n, length = len(words), len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).reshape(n, length).astype(np.uint64) + np.uint64(1)
        up = np.ones(length + 1, dtype=np.uint64)
        up[1:] = np.multiply.accumulate(np.full(length, CHAR_BASE, dtype=np.uint64))
        down = np.ones(length + 1, dtype=np.uint64)
        down[1:] = np.multiply.accumulate(np.full(length, pow(CHAR_BASE, -1, 1 << 64), dtype=np.uint64))
        total = np.zeros((length + 1, n), dtype=np.uint64)
        np.cumsum((codes * up[1:]).T, axis=0, out=total[1:])
        bpe, unknown = self.vocabulary.kind == "bpe", len(self.vocabulary.pieces)
        best = np.zeros((length + 1, n))
        last = np.full((length + 1, n), unknown, dtype=np.int64)
        back = np.ones((length + 1, n), dtype=np.int64)
        rows = np.arange(n)
        for end in range(1, length + 1):
            hits = []
            for width in range(1, min(self.longest, end) + 1):
                key = (total[end] - total[end - width]) * down[end - width]
                slot = key >> BITMAP_SHIFT
                some = np.flatnonzero(self.bitmap[slot])
                hits.append((width, *self._probe(some, key[some], slot[some])))
            if bpe:
                # One piece fits every position, most often the longest.
                open_ = np.ones(n, dtype=bool)
                for width, some, ids in reversed(hits):
                    left = open_[some]
                    some, ids = some[left], ids[left]
                    if end > width:
                        fits = self._joins(last[end - width, some], ids)
                        some, ids = some[fits], ids[fits]
                    open_[some] = False
                    last[end, some], back[end, some] = ids, width
                continue
            value = np.full((len(hits), n), -np.inf)
            piece = np.full((len(hits), n), unknown, dtype=np.int64)
            for width, some, ids in hits:
                value[width - 1, some] = best[end - width, some] + self.scores[ids]
                piece[width - 1, some] = ids
            # A character outside the vocabulary is a path of length 1.
            free = piece[0] == unknown
            value[0, free] = best[end - 1, free] + self.unknown_score
            pick = value.argmax(axis=0)
            best[end] = value[pick, rows]
            last[end] = piece[pick, rows]
            back[end] = pick + 1
        found, of_row = [], []
        at, going = np.full(n, length), rows
        while len(going):
            here = at[going]
            found.append(last[here, going])
            of_row.append(going)
            at[going] = here - back[here, going]
            going = going[at[going] > 0]
        ids, of_row = np.concatenate(found[::-1]), np.concatenate(of_row[::-1])
        order = np.argsort(of_row, kind="stable")
        ids, ends = ids[order].astype(np.int32), np.append(0, np.cumsum(np.bincount(of_row, minlength=n)))
        flat = ids.tobytes()
        out = [flat[4 * lo : 4 * hi] for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist())]
        for r in np.unique(of_row[order][ids == unknown]).tolist():
            out[r] = self._final(words[r], ids[ends[r] : ends[r + 1]].tolist())
        return out

    def _final(self, word: str, ids: list[int]) -> bytes:
        """Unknown characters become bytes, or one unknown id in a row."""
        v = self.vocabulary
        unknown = len(v.pieces)
        out, at = [], 0
        for i in ids:
            if i != unknown:
                out.append(i)
                at += len(v.pieces[i])
                continue
            if v.bytes_at:
                out += [v.bytes_at[b] for b in word[at].encode()]
            elif not out or out[-1] != v.unknown:
                out.append(v.unknown)
            at += 1
        return np.array(out, dtype=np.int32).tobytes()

    def _plainly(self, word: str) -> bytes:
        return self._final(word, [self.id_of.get(p, len(self.vocabulary.pieces)) for p in merged(word, self.rank_of)])

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of distinct words, as int32 bytes."""
        out: dict[str, bytes] = {}
        by_length: dict[int, list[str]] = {}
        tied = self.tied if self.vocabulary.kind == "bpe" else []
        search = re.compile("|".join(map(re.escape, tied))).search if tied else lambda w: None
        for w in words:
            if search(w):
                out[w] = self._plainly(w)
            else:
                by_length.setdefault(len(w), []).append(w)
        for length, group in by_length.items():
            step = max(1, min(ROWS, CELLS // (length + 1)))
            for lo in range(0, len(group), step):
                part = group[lo : lo + step]
                out.update(zip(part, self._walk(part)))
        return out

    def encode_batch(self, texts: list[str | None], cache: dict[str, bytes]) -> list[np.ndarray]:
        """Ids of whole texts. ``cache`` keeps the ids of short words."""
        v = self.vocabulary
        split = []
        for t in texts:
            plain = (t or "").replace(" ", SPACE)
            split.append(self.splitter.findall((SPACE + plain if v.dummy_prefix else plain) if plain else ""))
        words = set(chain.from_iterable(split))
        new = words.difference(cache)
        if len(cache) + len(new) > CACHE_WORDS:
            cache.clear()
            new = words
        found = self.encode_words(list(new))
        long = {w: ids for w, ids in found.items() if len(w) > CACHE_CHARS}
        cache.update(found)
        out = [self._one_unknown(np.frombuffer(b"".join(map(cache.__getitem__, own)), dtype=np.int32)) for own in split]
        for w in long:
            del cache[w]
        return out

    def _one_unknown(self, ids: np.ndarray) -> np.ndarray:
        """Without byte pieces, unknown ids in a row are one, across words too."""
        v = self.vocabulary
        if v.bytes_at or not len(ids):
            return ids
        same = (ids[1:] == v.unknown) & (ids[:-1] == v.unknown)
        return ids[np.concatenate(([True], ~same))]


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    return "\ufffd" * (error.end - error.start), error.end


class Decoder:
    def __init__(self, vocabulary: Vocabulary):
        v = vocabulary
        self.text = ["" if i in v.controls else p.replace(SPACE, " ") for i, p in enumerate(v.pieces)]
        self.text[v.unknown] = " ⁇ "
        self.byte_of = {i: b for b, i in v.bytes_at.items()}
        self.is_byte = np.zeros(len(v.pieces), dtype=bool)
        self.is_byte[list(self.byte_of)] = True
        self.dummy_prefix = v.dummy_prefix
        codecs.register_error("each-byte", _each_byte)

    def decode(self, ids: np.ndarray | None) -> str:
        """The text of ids; bytes that are not UTF-8 become U+FFFD each."""
        if ids is None or not len(ids):
            return ""
        if not self.is_byte[ids].any():
            out = "".join([self.text[i] for i in ids.tolist()])
        else:
            parts, run = [], bytearray()
            for i in ids.tolist():
                if i in self.byte_of:
                    run.append(self.byte_of[i])
                    continue
                parts.append(run.decode("utf-8", "each-byte"))
                run.clear()
                parts.append(self.text[i])
            parts.append(run.decode("utf-8", "each-byte"))
            out = "".join(parts)
        return out[1:] if self.dummy_prefix and out.startswith(" ") else out


#: Texts that are encoded together, in characters.
BATCH_CHARS = 4 << 20


def _batches(texts: list[str | None]) -> Iterator[list[str | None]]:
    lo = size = 0
    for hi, t in enumerate(texts):
        size += len(t or "")
        if size >= BATCH_CHARS:
            yield texts[lo : hi + 1]
            lo, size = hi + 1, 0
    if lo < len(texts):
        yield texts[lo:]


def _renamed(docs: DataFrame) -> tuple[DataFrame, list[str], str]:
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)])
    return rows, names, ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text") -> DataFrame:
    """Every column of ``docs`` by position (c0, c1, ...) and ids, the pieces of
    each whole text. Null and empty texts have no ids; repeated rows are encoded
    each. The vocabulary is a file of bounded size and is broadcast."""
    rows, names, schema = _renamed(docs)
    at = docs.columns.index(text_col)
    held = docs.sparkSession.sparkContext.broadcast(Encoder(vocabulary).state())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, cache = Encoder.of(held.value), {}
        for batch in batches:
            lo = 0
            for texts in _batches(batch.column(at).to_pylist()):
                found = encoder.encode_batch(texts, cache)
                offsets = np.concatenate(([0], np.cumsum([len(i) for i in found])))
                flat = np.concatenate(found) if found else np.zeros(0, dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([*[c.slice(lo, len(texts)) for c in batch.columns], ids], [*names, "ids"])
                lo += len(texts)

    return rows.mapInArrow(run, f"{schema}, ids array<int>")


def decode(coded: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids") -> DataFrame:
    """Every column of ``coded`` by position (c0, c1, ...) and decoded, the text
    of its ids (empty for null and for no ids)."""
    rows, names, schema = _renamed(coded)
    at = coded.columns.index(ids_col)
    held = coded.sparkSession.sparkContext.broadcast(vars(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(Vocabulary(**held.value))
        for batch in batches:
            column = batch.column(at)
            values, offsets = np.asarray(column.values), np.asarray(column.offsets)
            held_text = [decoder.decode(values[a:b]) if ok else "" for a, b, ok in zip(offsets[:-1], offsets[1:], column.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(held_text, pa.string())], [*names, "decoded"])

    return rows.mapInArrow(run, f"{schema}, decoded string")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = Vocabulary.load(MODEL_PATH)
    coded = encode(read_table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary).toDF("doc_id", "text", "ids")
    text = F.coalesce("c1", F.lit(""))
    return decode(coded, vocabulary).select(
        F.col("c0").alias("doc_id"), F.size("c2").cast("long").alias("n_ids"), F.xxhash64("c2").alias("ids_hash"),
        F.length("decoded").cast("long").alias("decoded_chars"), (F.col("decoded") == text).alias("round_trip"))
