"""Benchmark decontamination: Wu-Manber search for many word patterns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ALNUM, LOWER, WORD_BASE, Chunk, chunks, materialize, mix64, range_hash, read_table

WINDOW_WORDS = 13

#: Benchmark text that one broadcast set of tables is built from; a larger
#: benchmark is searched for block by block.
BENCH_BYTES = 16 << 20

#: Entries of a shift table.
TABLE = 1 << 18

#: Window ends that one lane of the batched scan walks over.
LANE = 256

PATTERN_BASE = 0xA24BAED4963EE407


def _words(text: str | None) -> list[bytes]:
    chunk = Chunk(0, LOWER[np.frombuffer((text or "").encode(), dtype=np.uint8)], np.array([0, len((text or "").encode())]), ALNUM)
    raw = chunk.data.tobytes()
    return [raw[a:b] for a, b in zip(chunk.starts, chunk.ends)]


def _blocks(words: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """Table slots of the word blocks that end at ``ends``."""
    if width == 1:
        return (mix64(words[ends]) & np.uint64(TABLE - 1)).astype(np.int64)
    return (mix64(words[ends] * np.uint64(0x9FB21C651E98DF25) + words[ends - 1]) & np.uint64(TABLE - 1)).astype(np.int64)


class Tables:
    """Shift and bucket tables for the patterns of one length in words."""

    def __init__(self, length: int, patterns: dict[tuple[bytes, ...], set[str]]):
        self.length = length
        self.width = 2 if length > 1 else 1
        self.patterns = sorted(patterns)
        self.items = [sorted(patterns[p]) for p in self.patterns]
        raw = [w for p in self.patterns for w in p]
        ends = np.cumsum([len(w) for w in raw])
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        words = range_hash(data, ends - [len(w) for w in raw], ends, WORD_BASE)
        self.shift = np.full(TABLE, length - self.width + 1, dtype=np.int64)
        heads = np.arange(len(self.patterns)) * length
        for at in range(self.width - 1, length):
            np.minimum.at(self.shift, _blocks(words, heads + at, self.width), length - 1 - at)
        suffix = _blocks(words, heads + length - 1, self.width)
        order = np.argsort(suffix, kind="stable")
        self.order = order
        self.bucket = np.searchsorted(suffix[order], np.arange(TABLE + 1))
        self.whole = range_hash(words, heads, heads + length, PATTERN_BASE)

    @classmethod
    def of(cls, state: dict) -> Tables:
        """From another's attributes: broadcasts carry plain arrays and lists."""
        out = cls.__new__(cls)
        out.__dict__.update(state)
        return out

    def search(self, chunk: Chunk, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(last word, pattern) of every occurrence in the chunk's texts."""
        m = self.length
        firsts, stops = chunk.first[:-1] + m - 1, chunk.first[1:]
        some = stops > firsts
        firsts, stops = firsts[some], stops[some]
        lanes = -(-(stops - firsts) // LANE)
        step = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = np.repeat(firsts, lanes) + step * LANE
        stop = np.minimum(at + LANE, np.repeat(stops, lanes))
        ends, slots = [], []
        while len(at):
            slot = _blocks(words, at, self.width)
            skip = self.shift[slot]
            stay = skip == 0
            if stay.any():
                ends.append(at[stay])
                slots.append(slot[stay])
            at = at + np.maximum(skip, 1)
            going = at < stop
            at, stop = at[going], stop[going]
        if not ends:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        end, slot = np.concatenate(ends), np.concatenate(slots)
        size = self.bucket[slot + 1] - self.bucket[slot]
        whole = range_hash(words, end - m + 1, end + 1, PATTERN_BASE)
        place = np.repeat(np.arange(len(end)), size)
        which = self.order[np.repeat(self.bucket[slot], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)]
        alike = whole[place] == self.whole[which]
        end, which = end[place[alike]], which[alike]
        raw, starts, stops = chunk.data, chunk.starts, chunk.ends
        same = np.array([all(raw[starts[e - m + 1 + k] : stops[e - m + 1 + k]].tobytes() == w for k, w in enumerate(self.patterns[p]))
                         for e, p in zip(end.tolist(), which.tolist())], dtype=bool)
        return end[same], which[same]


def build(items: list[tuple[str | None, str | None]], window: int = WINDOW_WORDS) -> list[Tables]:
    """Search tables for (item id, text) pairs, one for each pattern length."""
    by_length: dict[int, dict[tuple[bytes, ...], set[str]]] = {}
    for item, text in items:
        words = _words(text)
        m = min(window, len(words))
        for i in range(len(words) - m + 1 if m else 0):
            ids = by_length.setdefault(m, {}).setdefault(tuple(words[i : i + m]), set())
            if item is not None:
                ids.add(item)
    return [Tables(m, p) for m, p in sorted(by_length.items())]


SPANS = "array<struct<start: bigint, n: bigint>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("n", pa.int64())]))


def _hits(tables: list[Tables], chunk: Chunk) -> list[tuple[list[tuple[int, int]], set[str]]]:
    """Per text of the chunk: (first word, words) of each occurrence, and its items."""
    out: list[tuple[list[tuple[int, int]], set[str]]] = [([], set()) for _ in range(len(chunk))]
    words = chunk.word_hashes()
    for t in tables:
        end, which = t.search(chunk, words)
        owner = np.searchsorted(chunk.first, end, side="right") - 1
        for e, p, d in zip(end.tolist(), which.tolist(), owner.tolist()):
            out[d][0].append((e - t.length + 1 - int(chunk.first[d]), t.length))
            out[d][1].update(t.items[p])
    return out


def _merged(n: int, spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    depth = np.zeros(n + 1, dtype=np.int64)
    for start, m in spans:
        depth[start] += 1
        depth[start + m] -= 1
    edge = np.flatnonzero(np.diff(np.concatenate(([0], np.cumsum(depth[:-1]) > 0, [0])).astype(np.int8)))
    return [{"start": int(a), "n": int(b - a)} for a, b in zip(edge[::2], edge[1::2])]


def _result_rows(tables, names: list[str], earlier: bool):
    """Counts, merged spans and items of every row. With ``earlier`` the last
    two columns hold spans and items that searches for other blocks found."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_tables = [Tables.of(t) for t in tables.value] if tables else []
        for batch in batches:
            n_words, n_hit, items, spans = [], [], [], []
            before = batch.columns[-2:] if earlier else None
            for chunk in chunks(batch, "__text", ALNUM, lower=True):
                for i, (found, ids) in enumerate(_hits(own_tables, chunk)):
                    if before:
                        found = found + [(s["start"], s["n"]) for s in before[0][chunk.lo + i].as_py() or []]
                        ids = ids.union(before[1][chunk.lo + i].as_py() or [])
                    n = int(chunk.first[i + 1] - chunk.first[i])
                    merged = _merged(n, found) if found else []
                    n_words.append(n)
                    n_hit.append(sum(s["n"] for s in merged))
                    items.append(sorted(ids, key=str.encode))
                    spans.append(merged)
            own = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                 pa.array(items, pa.list_(pa.string())), pa.array(spans, _SPANS)], [*names, "n_words", "n_hit", "items", "spans"])
    return run


def _found_rows(tables):
    """Only rows with occurrences: their keys, spans and items."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_tables = [Tables.of(t) for t in tables.value]
        for batch in batches:
            rows, items, spans = [], [], []
            for chunk in chunks(batch, "__text", ALNUM, lower=True):
                for i, (found, ids) in enumerate(_hits(own_tables, chunk)):
                    if found:
                        rows.append(chunk.lo + i)
                        spans.append(_merged(int(chunk.first[i + 1] - chunk.first[i]), found))
                        items.append(sorted(ids))
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))],
                ["k1", "k2", "spans", "items"])
    return run


def search(docs: DataFrame, bench: DataFrame, window: int = WINDOW_WORDS, bench_bytes: int = BENCH_BYTES,
           text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Every column of ``docs`` by position (c0, c1, ...) and n_words, n_hit,
    items (sorted strings) and spans (hit words, merged) of each row.

    Null, empty and wordless texts have no words and no hits; items without
    words are never found; items with a null id hit words but are not listed;
    an empty benchmark hits nothing. Repeated rows are searched each.
    """
    spark = docs.sparkSession
    items = bench.select(F.col(f"`{item_col}`").cast("string").alias("item"), F.col(f"`{item_text_col}`").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // bench_bytes))
    items = items.withColumn("part", F.pmod(F.xxhash64("item", "text"), F.lit(parts)))
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)], F.col(f"`{text_col}`").alias("__text"))
    schema = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)
    schema += f", n_words long, n_hit long, items array<string>, spans {SPANS}"

    def tables(part: int):
        built = build([(r["item"], r["text"]) for r in items.where(F.col("part") == part).toLocalIterator()], window)
        return spark.sparkContext.broadcast([vars(t) for t in built])

    if parts == 1:
        return rows.mapInArrow(_result_rows(tables(0), names, False), schema)
    keys = [F.xxhash64("__text").alias("k1"), F.xxhash64(F.lit("text"), "__text").alias("k2")]
    found = None
    for part in range(parts):
        held = tables(part)
        one = materialize(rows.where("__text is not null").select(*keys, "__text").mapInArrow(
            _found_rows(held), f"k1 long, k2 long, spans {SPANS}, items array<string>").dropDuplicates(["k1", "k2"]), "found")
        held.unpersist()
        found = one if found is None else found.unionAll(one)
    found = found.groupBy("k1", "k2").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    joined = rows.select("*", *keys).join(found, ["k1", "k2"], "left").select(*names, "__text", "spans", "items")
    return joined.mapInArrow(_result_rows(None, names, True), schema)


#: A document is contaminated if at least one in so many of its words is hit.
HIT_SHARE = 20


def contaminated():
    return (F.col("n_hit") > 0) & (F.col("n_hit") * HIT_SHARE >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """``docs`` without the contaminated rows, its columns as they were."""
    names = docs.columns
    found = search(docs, bench).where(~contaminated())
    return found.toDF(*[f"x{i}" for i in range(len(found.columns))]).select(*[F.col(f"x{i}").alias(c) for i, c in enumerate(names)])


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = search(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("c0").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"))


OP2_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
bi AS (SELECT item_id, ws, least(13, len(ws)) AS m, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0),
bw AS (SELECT DISTINCT item_id, m, md5(array_to_string(ws[i:i + m - 1], ' ')) AS h FROM bi),
ms AS (SELECT DISTINCT m FROM bw),
di AS (SELECT doc_id, ws, ms.m, unnest(range(1, len(ws) - ms.m + 2)) AS i FROM d, ms WHERE len(ws) >= ms.m),
dw AS (SELECT doc_id, m, i, md5(array_to_string(ws[i:i + m - 1], ' ')) AS h FROM di),
hit AS (SELECT dw.doc_id, dw.m, dw.i, bw.item_id FROM dw JOIN bw ON dw.m = bw.m AND dw.h = bw.h),
pos AS (SELECT DISTINCT doc_id, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT doc_id, i, m FROM hit)),
np AS (SELECT doc_id, count(*) AS n FROM pos GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(np.n, 0)::BIGINT AS n_hit, coalesce(it.n, 0)::BIGINT AS n_items,
  sha256(coalesce(it.ids, '')) AS items_sha256,
  coalesce(np.n, 0) > 0 AND 20 * coalesce(np.n, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN np USING (doc_id) LEFT JOIN it USING (doc_id)
"""
