"""Spelling variants: words that differ by one inserted, deleted or replaced
letter, grouped under their most frequent form, by PartEnum signatures.

A word's letters are a binary vector with a dimension for each (letter, k-th
occurrence). One edit changes at most two dimensions, so near words have a
Hamming distance of at most two. The dimensions are dealt into PARTS parts; for
any two parts left out, the rest is a signature. Two dimensions touch at most
two parts, so near words share at least one signature: the equi-join on the
signature (with the length and a half of the word) misses no pair, and every
pair that meets is verified.

Null and empty texts have no words; a null id is written as nothing before the
colon; repeated rows count each; an empty table has no words. Other columns are
not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, mix64, read_table

#: Runs of letters, after A-Z became a-z, and what ends them.
RUN = re.compile("[a-z\u00C0-\u00FF]+")
GAP = re.compile("[^a-z\u00C0-\u00FF]")

#: Characters of a text that are looked at in one go.
PIECE_CHARS = 1 << 20

#: Different words that a task adds up before it hands them on.
HELD_WORDS = 500_000

MIN_LETTERS = 5
MIN_TIMES = 3

#: A run whose checksum this divides loses a letter.
SLIP = 97

#: Parts of the dimensions; two are left out of each signature (6 choices of 4).
PARTS = 4
MAX_BITS = 2

#: Words that share a key beyond which they meet letter by letter.
BUCKET_WORDS = 128

#: A form is at least so many times as frequent.
FORM_TIMES = 2


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """A long text in pieces that end between runs."""
    lo = 0
    while len(text) - lo > size:
        gap = GAP.search(text, lo + size)
        hi = gap.start() if gap else len(text)
        yield text[lo:hi]
        lo = hi
    yield text[lo:]


def slipped_words(doc_id: str, text: bytes, slip: int = SLIP) -> Iterator[tuple[str, int]]:
    """The words of one text and how often each occurs: runs of letters, of
    which one letter goes if ``slip`` divides the checksum of id and run."""
    seed = zlib.crc32(f"{doc_id}:".encode())
    crc32 = zlib.crc32
    for piece in pieces(text.lower().decode()):  # bytes.lower() changes A-Z only
        found = Counter(RUN.findall(piece))
        for run in [r for r in found if not crc32(r.encode(), seed) % slip]:
            at = crc32(run.encode(), seed) % len(run)
            yield run[:at] + run[at + 1 :], found.pop(run)
        yield from found.items()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS,
                min_times: int = MIN_TIMES, slip: int = SLIP) -> DataFrame:
    """(word, n): the words that are long and frequent enough. A task adds up
    what it has seen and hands it on when it holds HELD_WORDS different words."""

    def counted(held: dict[str, int]) -> pa.RecordBatch:
        long = [(w, n) for w, n in held.items() if len(w) >= min_letters]
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in long], pa.string()), pa.array([n for _, n in long], pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            for doc_id, text in zip(batch.column(0).to_pylist(), texts):
                for word, times in slipped_words(doc_id, text.as_py() or b"", slip):
                    held[word] = held.get(word, 0) + times
                if len(held) >= HELD_WORDS:
                    yield counted(held)
                    held = {}
        yield counted(held)

    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), F.col(f"`{text_col}`"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_times)


def part_sums(words: list[str], parts: int) -> np.ndarray:
    """A row per word: for each part the sum of the hashes of the word's
    dimensions in it. Equal letters of a part have equal sums."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    owner = np.repeat(np.arange(len(words)), lengths)
    order = np.lexsort((codes, owner))
    codes, owner = codes[order], owner[order]
    fresh = np.ones(len(codes), dtype=bool)
    fresh[1:] = (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])
    run = np.flatnonzero(fresh)
    occurrence = np.arange(len(codes)) - run[np.cumsum(fresh) - 1] if len(codes) else codes
    dimension = mix64(((codes << 32) | occurrence).astype(np.uint64) + np.uint64(1))
    sums = np.zeros((len(words), parts), dtype=np.uint64)
    np.add.at(sums, (owner, (dimension % np.uint64(parts)).astype(np.int64)), mix64(dimension))
    return sums


def left_out(parts: int) -> list[tuple[int, int]]:
    """Every choice of two parts; first come those that together name each part."""
    pairs = [(i, min(i + 1, parts - 1)) if i + 1 < parts else (i - 1, i) for i in range(0, parts, 2)]
    return pairs + [c for c in combinations(range(parts), MAX_BITS) if c not in pairs]


def part_signatures(words: list[str], parts: int = PARTS) -> np.ndarray:
    """A row per word: a hash of its dimensions for each choice of two parts
    left out. Vectors that differ in two dimensions agree in one at least,
    vectors that differ in one dimension in one of the first ceil(parts / 2)."""
    sums = part_sums(words, parts)
    whole = sums.sum(axis=1, dtype=np.uint64)
    out = [mix64(whole - sums[:, i] - sums[:, j] + np.uint64(n)) for n, (i, j) in enumerate(left_out(parts))]
    return np.stack(out, axis=1).view(np.int64)


def signatures(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """(word, key, long): where each word meets others. A key is a signature,
    the length of the shorter word, and that word's first or second half: an
    edit leaves one of the halves as it is. A word has keys among words of its
    length, and ``long`` ones among words one letter shorter, whose vectors are
    one dimension off, so that fewer signatures do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = part_signatures(batch.column(0).to_pylist(), parts)
            offsets = np.arange(0, found.size + 1, found.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel()))], ["word", "sigs"])

    length = F.char_length("word")

    def keys(sigs: Column, short: Column, long: bool) -> Column:
        half = F.floor(short / 2).cast("int")
        head = F.xxhash64(short, F.lit("head"), F.col("word").substr(F.lit(1), half))
        tail = F.xxhash64(short, F.lit("tail"), F.col("word").substr(length - short + half + 1, short - half))
        return F.transform(sigs, lambda sig: F.struct(F.array(F.xxhash64(sig, head), F.xxhash64(sig, tail)).alias("keys"), F.lit(long).alias("long")))

    rows = words.select("word").mapInArrow(run, "word string, sigs array<long>")
    every = F.concat(keys(F.col("sigs"), length, False), keys(F.slice("sigs", 1, (parts + 1) // 2), length - 1, True))
    return rows.select("word", F.explode(every).alias("x")).select("word", F.explode("x.keys").alias("key"), "x.long")


def without(word: Column, i: Column) -> Column:
    return F.concat(word.substr(F.lit(1), i), word.substr(i + 2, F.char_length(word)))


def near_pairs(words: DataFrame, parts: int = PARTS, bucket_words: int = BUCKET_WORDS) -> DataFrame:
    """(word, near), both ways: all pairs that are one edit apart.

    Where more than ``bucket_words`` words share a key, they meet in it only on
    what is left when one letter at one place goes: at most one word per letter
    of the alphabet has the same rest of the same length, so no group is ever
    paired in full.
    """
    keyed = materialize(signatures(words, parts), "signatures")
    large = materialize(keyed.groupBy("key").count().where(F.col("count") > bucket_words).select("key"), "buckets")

    def pairs(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
        met = a.where(~F.col("long")).select(*key, F.col("word").alias("a")).join(b.select(*key, F.col("word").alias("b"), "long"), key)
        return met.where((F.col("long") | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1)).select("a", "b")

    if large.isEmpty():
        found = pairs(keyed, keyed, ["key"])
    else:
        sparse, dense = keyed.join(large, "key", "left_anti"), keyed.join(large, "key", "left_semi")
        # Replaced: the same place gone from both. Inserted: the shorter whole is what is left of the longer.
        gone = F.transform(F.sequence(F.lit(0), F.char_length("word") - 1), lambda i: F.struct(
            F.when(F.col("long"), -1).otherwise(i).alias("place"), F.xxhash64(without(F.col("word"), i)).alias("rest")))
        whole = F.array(F.struct(F.lit(-1).alias("place"), F.xxhash64("word").alias("rest")))
        found = pairs(sparse, sparse, ["key"]).unionAll(pairs(
            dense.withColumn("left", F.explode(F.concat(gone, whole))), dense.withColumn("left", F.explode(gone)), ["key", "left"]))
    both = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near")), F.struct(F.col("b").alias("word"), F.col("a").alias("near")))
    return materialize(found.distinct(), "near").select(F.explode(both).alias("x")).select("x.*")


def forms(words: DataFrame, near: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n): the form is the most frequent near word
    (of equals the first in code-point order), if it is frequent enough."""
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = near.join(counts, "near").groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    joined = words.join(best, "word", "left")
    far = -F.col("best.less") >= FORM_TIMES * F.col("n")
    return joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                         F.when(far, F.col("best.near")).alias("form"), F.when(far, -F.col("best.less")).alias("form_n"))


def roots(table: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last. Counts at least double from
    word to form, so no chain is longer than 62; pointers double each round."""
    state = materialize(table.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        onward = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize(state.join(onward, "root").select("word", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "roots")
        state = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return state


def group_variants(words: DataFrame, parts: int = PARTS, bucket_words: int = BUCKET_WORDS) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for a table of distinct words and
    their counts (word, n)."""
    words = materialize(words.select("word", "n"), "words")
    table = materialize(forms(words, near_pairs(words, parts, bucket_words)), "forms")
    return table.join(roots(table), "word")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(word_counts(read_table(spark, sf_dir, "documents"))).select("word", "form", "root", "n", "n_near", "form_n")


OP13_SQL = """
WITH RECURSIVE crc_table AS MATERIALIZED (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc),
runs AS MATERIALIZED (
  SELECT doc_id, run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
        FROM documents)
  GROUP BY ALL),
hexed AS (
  SELECT run, times, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs),
hashed AS MATERIALIZED (
  SELECT run, times, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(length(x) // 2),
           lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)), lambda c, b: xor(c >> 8, crc[1 + (xor(c, b) & 255)]))) AS h
  FROM hexed, crc_table),
words AS MATERIALIZED (
  SELECT word, sum(times)::BIGINT AS n
  FROM (SELECT times, CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, 2 + (h % length(run))::INT) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
gone AS MATERIALIZED (
  SELECT word, i, substr(word, 1, i::INT) || substr(word, i::INT + 2) AS rest
  FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
pairs AS MATERIALIZED (
  SELECT a.word, b.word AS near FROM gone a JOIN gone b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT gone.word, words.word FROM gone JOIN words ON gone.rest = words.word
  UNION SELECT words.word, gone.word FROM gone JOIN words ON gone.rest = words.word),
best AS (
  SELECT pairs.word, count(*) AS n_near, arg_min(near, (-b.n, near)) AS near, max(b.n) AS near_n
  FROM pairs JOIN words b ON b.word = pairs.near GROUP BY pairs.word),
found AS MATERIALIZED (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form, CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
  FROM words LEFT JOIN best ON best.word = words.word),
chain AS (
  SELECT word, word AS root FROM found
  UNION ALL SELECT chain.word, found.form FROM chain JOIN found ON found.word = chain.root WHERE found.form IS NOT NULL),
ends AS (
  SELECT chain.word, chain.root FROM chain JOIN found ON found.word = chain.root WHERE found.form IS NULL)
SELECT found.word, form, root, n, n_near, form_n FROM found JOIN ends ON ends.word = found.word"""
