import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopfloor.llm import lm_score as lm


def slots_of(text):
    """(word ids, pair slots): words that share a slot are one to the models."""
    data = np.frombuffer("".join(c.lower() if c.isascii() else c for c in text or "").encode(), dtype=np.uint8)
    word, pair, _ = lm._ids(lm.Chunk(0, data, np.array([0, len(data)]), lm.ALNUM))
    return word.tolist(), pair.tolist()[1:]


def plain(texts, wanted):
    """Cross-entropy differences by dictionaries, each text's own counts off."""
    tokens = [slots_of(t) for t in texts]

    def counts(picked):
        words, pairs, contexts = Counter(), Counter(), Counter()
        for t, p in picked:
            words.update(t)
            pairs.update(p)
            contexts.update(t[:-1])
        return words, pairs, contexts

    target, total = counts([t for t, w in zip(tokens, wanted) if w]), counts(tokens)
    vocabulary = len(total[0])
    scale = sum(target[0].values()) / sum(total[0].values())

    def loss(text, model, scale, counted):
        t, p = text
        if not t:
            return None
        own = counts([text]) if counted else (Counter(),) * 3
        words, pairs, contexts = ({k: max(scale * (m[k] - o[k]), 0) for k in m} for m, o in zip(model, own))
        size = scale * (sum(model[0].values()) - (len(t) if counted else 0))
        out = 0.0
        for i, w in enumerate(t):
            chance = (words.get(w, 0) + 1) / (size + vocabulary)
            if i:
                c = contexts.get(t[i - 1], 0)
                chance = (min(pairs.get(p[i - 1], 0), c) + lm.SMOOTHING * chance) / (c + lm.SMOOTHING)
            out -= math.log(chance)
        return out / len(t)

    return [(len(t[0]), loss(t, target, 1.0, w), loss(t, total, scale, True)) for t, w in zip(tokens, wanted)]


def test_matches_dictionaries(docs_of, prose, clashing):
    texts = [prose(40, seed=i) for i in range(30)] + ["one", "", None, "one one one", prose(40, seed=3), prose(2000, seed=50)]
    wanted = [i % 3 == 0 for i in range(len(texts))]
    docs = clashing(docs_of(list(enumerate(texts)))).withColumn("mine", F.when(F.col("doc_id") % 3 == 0, True))
    rows = {r.doc_id: r for r in lm.score(docs, F.col("mine")).collect()}
    for i, (n, t, b) in enumerate(plain(texts, wanted)):
        r = rows[i]
        assert r.n_tokens == n
        if n:
            assert r.target_loss == pytest.approx(t, rel=1e-5) and r.background_loss == pytest.approx(b, rel=1e-5)
            assert r.difference == pytest.approx(t - b, abs=1e-4)
        else:
            assert r.target_loss is None and r.difference is None


def test_target_like_texts_score_lower(spark, docs_of, prose):
    low = [(i, " ".join(f"alpha{j % 7} beta{j % 5}" for j in range(i, i + 40))) for i in range(40)]
    high = [(100 + i, " ".join(f"gamma{j % 7} delta{j % 5}" for j in range(i, i + 40))) for i in range(40)]
    rows = lm.score(docs_of(low + high), F.col("doc_id") < 20).collect()
    like = [r.difference for r in rows if 20 <= r.doc_id < 100]
    other = [r.difference for r in rows if r.doc_id >= 100]
    assert max(like) < min(other)


def test_no_target_no_rows_and_repeats(spark, docs_of):
    rows = lm.score(docs_of([(1, "a b c"), (1, "a b c"), (None, "a b")]), F.lit(False)).collect()
    assert [r.difference for r in rows] == pytest.approx([0, 0, 0])
    assert lm.score(docs_of([]), F.lit(True)).count() == 0


def test_target_ids_and_flags_give_equal_scores(spark, docs_of, prose, monkeypatch):
    """Over many blocks; null, repeated and unknown ids mark nothing more."""
    monkeypatch.setattr(lm, "BLOCK_BYTES", 1 << 12)
    docs = docs_of([(i % 50, prose(30, seed=i)) for i in range(60)] + [(None, "a b c"), (90, None)])
    ids = spark.createDataFrame([(i,) for i in (3, 3, 9, 17, 40, 999, None)], "good long")
    by_flag = lm.score(docs, F.col("doc_id").isin(3, 9, 17, 40)).collect()
    by_ids = lm.score(docs, F.lit(False), target_ids=ids).collect()
    assert sorted(map(str, by_flag)) == sorted(map(str, by_ids)) and len(by_ids) == 62
    none = lm.score(docs, F.lit(False), target_ids=ids.where("good = 999")).collect()
    assert all(r.difference is None or r.difference == pytest.approx(0) for r in none)


def test_rare_words_keep_their_own_counts(spark, docs_of, monkeypatch):
    """More distinct words and pairs than any fixed table of slots holds apart,
    over many blocks and buckets, against dictionaries of the words themselves."""
    monkeypatch.setattr(lm, "BLOCK_BYTES", 1 << 18)
    monkeypatch.setattr(lm, "BUCKET_BYTES", 1 << 19)
    texts = [" ".join(f"w{(i * 7919 + j * j) % 400_000}" for j in range(10_000)) for i in range(60)] + ["w1 w2 w1", None]
    tokens = [(t or "").split() for t in texts]
    words, pairs, contexts = Counter(), Counter(), Counter()
    for t in tokens:
        words.update(t)
        pairs.update(zip(t, t[1:]))
        contexts.update(t[:-1])
    target = Counter(w for t in tokens[:10] for w in t), Counter(p for t in tokens[:10] for p in zip(t, t[1:])), Counter(w for t in tokens[:10] for w in t[:-1])
    scale = sum(target[0].values()) / sum(words.values())
    vocabulary = len(words)
    rows = {r.doc_id: r for r in lm.score(docs_of(list(enumerate(texts))), F.col("doc_id") < 10).collect()}
    assert len(rows) == len(texts) and rows[61].n_tokens == 0 and rows[61].difference is None
    for i in (0, 9, 10, 59, 60):
        own = Counter(tokens[i]), Counter(zip(tokens[i], tokens[i][1:])), Counter(tokens[i][:-1])
        for got, model, by, counted in ((rows[i].target_loss, target, 1.0, i < 10), (rows[i].background_loss, (words, pairs, contexts), scale, True)):
            left = [lambda k, m=m, o=o: by * (m[k] - counted * o[k]) for m, o in zip(model, own)]
            size, loss = by * (sum(model[0].values()) - counted * len(tokens[i])), 0.0
            for j, w in enumerate(tokens[i]):
                chance = (left[0](w) + 1) / (size + vocabulary)
                if j:
                    before = tokens[i][j - 1]
                    chance = (left[1]((before, w)) + lm.SMOOTHING * chance) / (left[2](before) + lm.SMOOTHING)
                loss -= math.log(chance)
            assert got == pytest.approx(loss / len(tokens[i]), rel=1e-9)
