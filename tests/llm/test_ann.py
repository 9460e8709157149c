import numpy as np
import pytest
from pyspark.sql import functions as F

from shopfloor.llm import ann


def exact(table, queries, k):
    """{query: [(vec_id, score), ...]} by brute force, one order of summation."""
    out = {}
    for q in queries:
        scored = []
        for i, v in table.items():
            if i != q:
                s = 0.0
                for a, b in zip(table[q], v):
                    s += a * b
                scored.append((-s, i))
        out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def run(spark, rows, k=20, every=20, parts=4):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(parts)
    got = {}
    for r in ann.search(df, lambda i: i % every == 0, k).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    return got


def clusters(n, width, seed, scale=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((8, width))
    x = (centres[rng.integers(0, 8, n)] + 0.7 * rng.standard_normal((n, width))).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return x * np.float32(scale) if np.isscalar(scale) else (x * scale[:, None]).astype(np.float32)


@pytest.mark.parametrize("norms", ["unit", "mixed"])
def test_recall_and_exact_scores(spark, norms):
    rng = np.random.default_rng(3)
    x = clusters(3000, 32, 1, 1.0 if norms == "unit" else rng.uniform(0.5, 2.0, 3000))
    table = {i: v.astype(float).tolist() for i, v in enumerate(x)}
    got = run(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)])
    want = exact(table, [i for i in table if i % 20 == 0], 20)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (20 * len(want)) >= 0.9
    for q, found in got.items():
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
        assert all(s == pytest.approx(float(np.dot(x[q].astype(float), x[i].astype(float))), abs=1e-12) for i, s in found)


def test_radius_finds_every_code_within(spark):
    """Pigeonhole: the candidates are exactly the codes within the radius."""
    rng = np.random.default_rng(5)
    codes = rng.integers(0, 1 << 16, (400, 5), dtype=np.uint16)
    codes[200:] = codes[:200] ^ (rng.random((200, 5)) < 0.3).astype(np.uint16)
    index = ann.Index(np.arange(400), np.zeros((400, 2)), codes)
    for radius in (0, 1, 3, 17, 40, 80):
        far = np.bitwise_count(codes[:50, None, :] ^ codes[None, :, :]).sum(axis=2)
        assert np.array_equal(index.candidates(codes[:50], radius), far <= radius)
        assert sum(r + 1 for r in ann.radii(radius, 5)) == radius + 1


def test_ties_few_rows_and_rows_left_out(spark):
    rows = [(0, [1.0, 0.0], 0), (20, [1.0, 0.0], 0), (3, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [0.0, 1.0], 0), (4, [-1.0, 0.0], 0),
            (5, None, 0), (6, [], 0), (7, [0.0, 0.0], 0), (8, [None, 1.0], 0), (9, [float("nan"), 1.0], 0), (10, [float("inf"), 1.0], 0),
            (40, None, 0), (60, [0.0, 0.0], 0), (None, [1.0, 0.0], 0), (11, [1.0], 0), (3, [1.0, 0.0], 0)]
    got = run(spark, rows)
    assert set(got) == {0, 20}
    assert [i for i, _ in got[0]] == [1, 3, 20, 2, 4] and [i for i, _ in got[20]] == [0, 1, 3, 2, 4]


def test_many_copies_of_one_vector(spark):
    x = clusters(300, 16, 9)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(1000 + i, x[0].tolist(), 0) for i in range(900)]
    table = {i: np.asarray(v, dtype=np.float32).astype(float).tolist() for i, v, _ in rows}
    got = run(spark, rows)
    want = exact(table, [0, 1000, 1400], 20)
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]


def test_empty_and_without_queries(spark):
    assert run(spark, []) == {}
    assert run(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)]) == {}
    assert run(spark, [(20, [1.0, 2.0], 0)]) == {}


def test_blocks_and_shards(spark, monkeypatch):
    x = clusters(1200, 16, 11)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    whole = run(spark, rows)
    monkeypatch.setattr(ann, "QUERY_ROWS", 16)
    monkeypatch.setattr(ann, "INDEX_ROWS", 300)
    assert run(spark, rows) == whole


def test_each_length_is_searched_by_itself(spark):
    """One vector with a component too many takes nothing from the others."""
    x = clusters(200, 8, 4)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    got = run(spark, rows + [(1000, [1.0] * 9, 0), (1001, [2.0] * 9, 0)])
    want = run(spark, rows)
    assert {q: f for q, f in got.items() if q != 1000} == want
    assert got[1000] == [(1001, 18.0)]
