import numpy as np
import pytest
from pyspark.sql import functions as F

from shopfloor.llm import quality
from shopfloor.llm.common import read_table

SF = "/root/testdata/sf0.01"


def flat(sets):
    return np.array([b for s in sets for b in s], dtype=np.int64), np.concatenate(([0], np.cumsum([len(s) for s in sets])))


def test_fit_orders_grades_and_thresholds():
    rng = np.random.default_rng(0)
    grades = rng.integers(0, 4, 600)
    sets = [sorted({1000 + rng.integers(0, 500) for _ in range(5)} | {int(g)} ) for g in grades]
    model = quality.fit(*flat(sets), grades, 4)
    assert np.all(np.diff(model.thresholds) > 0)
    w = model.weights
    assert w[0] < w[1] < w[2] < w[3]
    tails = model.tails(np.array([w[g] for g in grades], dtype=float))
    assert np.all(np.diff(tails, axis=1) <= 0) and (np.round(tails.sum(axis=1)) == grades).mean() > 0.95


def test_likelihood_gradient_by_differences():
    """The fit climbs the ordinal likelihood: more steps, better likelihood."""
    rng = np.random.default_rng(1)
    grades = rng.integers(0, 3, 300)
    sets = [[int(g)] if rng.random() < 0.8 else [int(rng.integers(0, 3))] for g in grades]

    def loss(model):
        tails = np.concatenate((np.ones((300, 1)), model.tails(np.array([model.weights[s[0]] for s in sets], dtype=float)), np.zeros((300, 1))), axis=1)
        return -np.log(tails[np.arange(300), grades] - tails[np.arange(300), grades + 1]).mean()

    steps, losses = quality.STEPS, []
    try:
        for quality.STEPS in (5, 40, 300):
            losses.append(loss(quality.fit(*flat(sets), grades, 3)))
    finally:
        quality.STEPS = steps
    assert losses[0] > losses[1] > losses[2] - 1e-6


def test_held_out_documents(spark):
    docs = read_table(spark, SF, "documents")
    rated = quality.graded(read_table(spark, SF, "labels"))
    held = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(3)) == 0
    model = quality.train(docs, rated.where(~held))
    rows = quality.rate(docs.select("doc_id", "text"), model).withColumnRenamed("c0", "doc_id").join(rated.where(held), "doc_id").collect()
    kept = {g: [r.keep for r in rows if r.grade == g] for g in (0, 1, 2)}
    assert np.mean(kept[2]) > 0.9 and np.mean(kept[1]) < 0.5 and np.mean(kept[0]) < 0.6
    assert np.mean([r.expected_grade for r in rows if r.grade == 2]) > np.mean([r.expected_grade for r in rows if r.grade == 0])
    assert all(0 <= r.tail <= 1 and 0 <= r.expected_grade <= 2 for r in rows)


def test_odd_rows(spark, docs_of, clashing):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 1), (3, 1, 0), (None, 1, 0), (4, None, None), (99, 0, 0)], "doc_id long, quality int, toxic int")
    assert {(r.doc_id, r.grade) for r in quality.graded(labels).collect()} >= {(1, 2), (2, 1), (3, 0), (4, None)}
    pairs = [(1, "good text"), (2, "bad text"), (3, None), (3, ""), (None, "\n"), (1, "good text"), (4, "x " * 100_000), (5, "!!! ??? !!!")]
    docs = clashing(docs_of(pairs))
    model = quality.train(docs, quality.graded(labels))
    rows = quality.rate(docs, model).collect()
    assert len(rows) == len(pairs) and len({r.tail for r in rows if r.c0 == 1}) == 1
    assert quality.keep_good(docs, labels).columns == docs.columns


def test_without_labels_or_documents(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.train(docs_of([(1, "text")]), quality.graded(none))
    (row,) = quality.rate(docs_of([(1, "text")]), model).collect()
    assert row.tail == pytest.approx(1 / 3) and row.expected_grade == pytest.approx(1.0)
    assert quality.rate(docs_of([]), model).count() == 0
    one_grade = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.keep_good(docs_of([(1, "text")]), one_grade).count() == 1


def test_nothing_learned_rejects_nothing(spark, docs_of):
    docs = docs_of([(1, "text"), (None, None), (2, "toxic words")])
    for rows in ([], [(99, 0, 0)], [(1, None, None)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
        assert quality.keep_good(docs, labels).count() == 3


def test_fits_on_one_row_of_a_repeated_id(spark, docs_of, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit", lambda buckets, offsets, grades, n: seen.append(grades.tolist()))
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    quality.train(docs_of([(1, "same")] * 30 + [(1, f"text {i}") for i in range(30)] + [(2, None)]), quality.graded(labels))
    assert [sorted(x) for x in seen] == [[1, 2]]
