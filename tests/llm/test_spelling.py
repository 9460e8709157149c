"""Spelling variants against brute force."""
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import re

from shopfloor.llm import spelling


def edits_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_words(pairs):
    found = Counter()
    for i, text in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def brute_groups(words):
    out = {}
    for w, n in words.items():
        near = [v for v in words if edits_one(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form = best if best is not None and words[best] >= 2 * n else None
        out[w] = [form, n, len(near), words.get(form)]
    for w in out:
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        out[w].append(root)
    return out


def check(spark, words, **options):
    table = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    got = {r.word: [r.form, r.n, r.n_near, r.form_n, r.root] for r in spelling.group_variants(table, **options).collect()}
    assert got == brute_groups(words)
    return got


@pytest.fixture()
def vocabulary():
    rng = random.Random(3)
    letters = "abcdeé×"
    words = {}
    for _ in range(60):
        base = "".join(rng.choice(letters) for _ in range(rng.randint(5, 9)))
        words[base] = rng.randint(3, 400)
        for _ in range(12):
            w, at = base, rng.randrange(len(base))
            w = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice(letters) + w[at:], w[:at] + rng.choice(letters) + w[at + 1 :]])
            if len(w) >= 5:
                words[w] = rng.randint(3, 60)
    return words


@pytest.mark.parametrize("bucket_words", [1, 4, 10_000])
@pytest.mark.parametrize("parts", [3, 4, 5])
def test_groups_equal_brute_force(spark, vocabulary, parts, bucket_words):
    got = check(spark, vocabulary, parts=parts, bucket_words=bucket_words)
    assert any(form for form, *_ in got.values()) and any(root != (form or w) for w, (form, _, _, _, root) in got.items())


def test_dense_words_of_few_letters(spark):
    """All words of five letters out of two: hardly a signature tells them apart."""
    words = {f"{i:05b}".replace("0", "a").replace("1", "b"): 3 + i for i in range(32)}
    words |= {f"{i:06b}".replace("0", "a").replace("1", "b"): 200 - i for i in range(64)}
    check(spark, words, bucket_words=2)


def test_ties_and_chains(spark):
    check(spark, {"colour": 10, "color": 20, "colon": 20, "colors": 20, "aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48, "bbbbb": 96, "aaaba": 5})
    check(spark, {"alone": 3})
    check(spark, {})


def test_signatures_of_near_words_meet():
    rng = random.Random(5)
    for parts in (3, 4, 6, 7):
        for _ in range(200):
            a = "".join(rng.choice("abcdefg") for _ in range(rng.randint(4, 9)))
            at = rng.randrange(len(a))
            replaced, inserted = a[:at] + "z" + a[at + 1 :], a[:at] + rng.choice("abcz") + a[at:]
            sa, sr, si = spelling.part_signatures([a, replaced, inserted], parts)
            assert np.any(sa == sr) and np.any((sa == si)[: (parts + 1) // 2])


def test_words_equal_brute_force(spark, docs_of, clashing, prose, monkeypatch):
    pairs = [(i, " ".join(["Straße ÉCOLE école Zürich ×mal÷ don't ABCdef", prose(200, seed=i)])) for i in range(40)]
    pairs += [(None, "nullid nullid nullid"), (50, None), (51, ""), (52, " 123 "), (7, pairs[7][1]), (53, "longlonglong " * 30_000)]
    want = brute_words(pairs)
    got = {r.word: r.n for r in spelling.word_counts(clashing(docs_of(pairs))).collect()}
    assert got == want and any(w for w in want if not w.isascii())
    monkeypatch.setattr(spelling, "HELD_WORDS", 50)
    assert {r.word: r.n for r in spelling.word_counts(docs_of(pairs)).collect()} == want
    assert spelling.word_counts(docs_of([])).count() == 0


def test_pieces_end_between_runs():
    text = "abc defé ghi,jkl" * 50
    for size in (1, 3, 10, 10_000):
        cut = list(spelling.pieces(text, size))
        assert "".join(cut) == text
        assert [w for p in cut for w in spelling.RUN.findall(p)] == spelling.RUN.findall(text)
