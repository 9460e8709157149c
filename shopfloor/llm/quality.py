"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features gives every text a score s, and
ordered thresholds t1 < t2 < ... cut it into grades: P(grade < k) =
sigmoid(t_k - s). The expected grade is the sum of the tail probabilities
P(grade >= k); the tail of the best grade selects texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ALNUM, NON_SPACE, byte_table, chunks, mix64, read_table, text_key

#: Hash buckets of the feature space: the weights are this many floats.
BUCKETS = 1 << 18

#: Labelled rows to fit on, as an expectation: a fixed share of the label table
#: chosen by hash. All rows, if there are fewer.
TRAIN_ROWS = 10_000

#: A feature counts only if so many texts of the sample have it and their
#: grades differ from all texts' more than the luckiest of as many features
#: without meaning would (chi-square beyond 2 ln(features)). Words that a few
#: long texts happen to share would only add noise.
MIN_TEXTS = 4

#: Steps, step size and ridge weight of the fit.
STEPS, RATE, RIDGE = 150, 0.15, 2e-4

#: A text is selected if it reaches the best grade with this probability.
SELECT_AT = 0.5

#: Grades of the label table, worst first: toxic, poor, good.
GRADES = 3

PUNCTUATION = ~(ALNUM | byte_table(bytes(range(0x41, 0x5B)))) & NON_SPACE

_PUNCT, _SHAPE = np.uint64(0x51ED270B0A1F39C1), np.uint64(0x2545F4914F6CDD1D)


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(BUCKETS - 1)).astype(np.int64)


def features(batch: pa.RecordBatch, name: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Chunk by chunk (first row, buckets, offsets): the distinct features of
    each whole text. They are its lower-cased words, its runs of punctuation,
    and coarse shapes: repeated words, capitals, punctuation, word length."""
    words = chunks(batch, name, ALNUM, lower=True)
    for word, mark, plain in zip(words, chunks(batch, name, PUNCTUATION), chunks(batch, name, NON_SPACE)):
        n = len(word)
        hashes = word.word_hashes()
        texts = word.text_of_word()
        pairs = np.unique((texts << 18) | _slots(hashes))
        marks = np.unique((mark.text_of_word() << 18) | _slots(mix64(mark.word_hashes() ^ _PUNCT)))
        total = np.diff(word.first)
        some = np.maximum(total, 1)
        distinct = np.bincount(pairs >> 18, minlength=n)
        capital = np.add.reduceat(np.append((plain.data >= 0x41) & (plain.data <= 0x5A), 0).astype(np.int64), plain.offsets[:-1])
        capital[np.diff(plain.offsets) == 0] = 0
        size = np.maximum(np.diff(plain.offsets), 1)
        shapes = [
            np.floor(8 * distinct / some),
            np.floor(8 * np.minimum(1, 2 * capital / size)),
            np.floor(4 * np.minimum(3, np.diff(mark.first) / some)),
            np.minimum(np.floor(np.add.reduceat(np.append(word.ends - word.starts, 0), word.first[:-1]) * (total > 0) / some), 20),
            np.minimum(np.floor(np.log2(some)), 12),
        ]
        keys = [(np.arange(n) << 18) | _slots(mix64((np.full(n, 1000 * k) + s.astype(np.int64)).astype(np.uint64) ^ _SHAPE))
                for k, s in enumerate(shapes)]
        every = np.unique(np.concatenate([pairs, marks, *keys]))
        yield word.lo, every & (BUCKETS - 1), np.searchsorted(every, np.arange(n + 1) << 18)


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray
    #: False if there was no rated text to learn from; then nothing is rejected.
    learned: bool = True

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... in columns."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -40, 40)))


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    out = np.concatenate(([0.0], np.cumsum(values)))
    return out[offsets[1:]] - out[offsets[:-1]]


def fit(buckets: np.ndarray, offsets: np.ndarray, grades: np.ndarray, n_grades: int) -> Model:
    """Maximum likelihood by Adam over all rows. Thresholds are a first one and
    positive gaps, so that they keep their order."""
    n = len(grades)
    of_text = np.repeat(grades, np.diff(offsets))
    seen = np.stack([np.bincount(buckets[of_text == k], minlength=BUCKETS) for k in range(n_grades)], axis=1)
    expected = seen.sum(axis=1, keepdims=True) * np.bincount(grades, minlength=n_grades) / n
    texts = seen.sum(axis=1)
    luck = 2 * np.log(max(np.count_nonzero(texts), 2))
    keep = ((((seen - expected) ** 2 / np.maximum(expected, 1e-9)).sum(axis=1) > luck) & (texts >= MIN_TEXTS))[buckets]
    lengths = _sums(keep, offsets).astype(np.int64)
    names, slot = np.unique(buckets[keep], return_inverse=True)
    row = np.repeat(np.arange(n), lengths)
    ends = np.concatenate(([0], np.cumsum(lengths)))
    # Start from the grades' shares; a grade that never occurs is half a row.
    share = np.cumsum(np.bincount(grades, minlength=n_grades) + 0.5)[:-1] / (n + 0.5 * n_grades)
    start = np.log(share / (1 - share))
    theta = np.concatenate((np.zeros(len(names)), start[:1], np.log(np.maximum(np.diff(start), 1e-3))))
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        w, cut = theta[: len(names)], theta[len(names) :]
        thresholds = np.cumsum(np.concatenate((cut[:1], np.exp(cut[1:]))))
        score = _sums(w[slot], ends)
        edge = np.concatenate((np.full((n, 1), -40.0), thresholds[None, :] - score[:, None], np.full((n, 1), 40.0)), axis=1)
        below = 1 / (1 + np.exp(-np.clip(edge, -40, 40)))
        slope = below * (1 - below)
        pick = np.arange(n)
        chance = np.maximum(below[pick, grades + 1] - below[pick, grades], 1e-12)
        g_score = (slope[pick, grades + 1] - slope[pick, grades]) / chance / n
        g_cut = np.zeros((n, n_grades + 1))
        g_cut[pick, grades + 1] -= slope[pick, grades + 1] / chance / n
        g_cut[pick, grades] += slope[pick, grades] / chance / n
        g_threshold = g_cut[:, 1:-1].sum(axis=0)
        later = np.cumsum(g_threshold[::-1])[::-1]
        gradient = np.concatenate((
            np.bincount(slot, weights=g_score[row], minlength=len(names)) + RIDGE * w,
            later[:1], later[1:] * np.exp(cut[1:])))
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        rate = RATE * (1 - step / (STEPS + 1))
        theta = theta - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    weights = np.zeros(BUCKETS, dtype=np.float32)
    weights[names] = theta[: len(names)]
    cut = theta[len(names) :]
    return Model(weights, np.cumsum(np.concatenate((cut[:1], np.exp(cut[1:])))))


def label_grade(quality: Column, toxic: Column) -> Column:
    """0 toxic, 1 poor, 2 good; null where neither label tells."""
    return F.when(toxic == 1, 0).when(quality == 0, 1).when(quality == 1, 2)


def train(docs: DataFrame, ratings: DataFrame, n_grades: int = GRADES, rows: int = TRAIN_ROWS) -> Model:
    """Fit on about ``rows`` rated rows: ``ratings`` has doc_id and grade (the
    worst counts, if a document has several; null ids and grades are left out).
    Of rows that share an id one is fitted on, that with the smallest text key.
    Without rated texts every grade is as likely as the next, and the model is
    marked as not learned."""
    spark = docs.sparkSession
    rated = ratings.where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.min("grade").alias("grade"))
    total = rated.count()
    if total > rows:
        part = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
        rated = rated.where(part < int((1 << 20) * rows / total))
    rows_of = docs.select("doc_id", "text").join(F.broadcast(rated), "doc_id")
    picked = rows_of.groupBy("doc_id").agg(
        F.min_by("text", text_key(F.col("text"))).alias("text"), F.first("grade").cast("int").alias("grade")).select("text", "grade")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, buckets, offsets in features(batch, "text"):
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(buckets, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(lo, len(offsets) - 1), lists], ["grade", "buckets"])

    found = picked.mapInArrow(run, "grade int, buckets array<int>").toArrow()
    if not found.num_rows:
        return Model(np.zeros(BUCKETS, dtype=np.float32), np.log(np.arange(1, n_grades) / (n_grades - np.arange(1, n_grades))), learned=False)
    lists = found.column("buckets").combine_chunks()
    lists = lists if isinstance(lists, pa.Array) else pa.concat_arrays(lists.chunks)
    offsets = np.asarray(lists.offsets).astype(np.int64)
    grades = found.column("grade").to_numpy().astype(np.int64)
    return fit(np.asarray(lists.values), offsets - offsets[0], grades, n_grades)


def rate(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Every column of ``docs`` by position (c0, c1, ...) and expected_grade,
    tail (probability of the best grade) and keep (tail >= SELECT_AT; every
    row if the model learned nothing).

    Null, empty and blank texts are rated by their shape alone; repeated rows
    are rated each; ids may be null. Only the text is looked at.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)])
    text = names[docs.columns.index(text_col)]
    held = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds, model.learned))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*held.value)
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for lo, buckets, offsets in features(batch, text):
                scores[lo : lo + len(offsets) - 1] = _sums(own.weights[buckets].astype(np.float64), offsets)
            tails = own.tails(scores)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(tails.sum(axis=1)), pa.array(tails[:, -1]), pa.array((tails[:, -1] >= SELECT_AT) | (not own.learned))],
                [*names, "expected_grade", "tail", "keep"])

    schema = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)
    return rows.mapInArrow(run, f"{schema}, expected_grade double, tail double, keep boolean")


def graded(labels: DataFrame) -> DataFrame:
    return labels.select("doc_id", label_grade(F.col("quality"), F.col("toxic")).alias("grade"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that the classifier rejects; all of them if no
    label meets a document, as then nothing tells a bad text."""
    model = train(docs, graded(labels))
    names = docs.columns
    return rate(docs, model).where("keep").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, graded(read_table(spark, sf_dir, "labels")))
    return rate(docs, model).select(F.col("c0").alias("doc_id"), "expected_grade", "tail", "keep")
