import hashlib
import re
from collections import Counter

from pyspark.sql import functions as F

from shopfloor.llm import substring
from shopfloor.llm.common import CHUNK_BYTES


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def plain(texts, window):
    """Kept words and removed flags of each text."""
    split = [words_of(t) for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        out.append(([x for x, g in zip(w, gone) if not g], gone))
    return out


def check(docs, pairs, window):
    rows = substring.cut_repeats(docs, window).select("c0", "n_words", "n_removed", "spans", "kept_text").collect()
    want = plain([t for _, t in pairs], window)
    got = sorted((str(r.c0), r.n_words, r.n_removed, r.kept_text) for r in rows)
    assert got == sorted((str(i), len(g), sum(g), " ".join(k)) for (i, _), (k, g) in zip(pairs, want))
    for r in rows:
        assert sum(s.n for s in r.spans) == r.n_removed


def test_matches_brute_force(docs_of, prose, clashing):
    passage = prose(60, seed=1)
    p = passage.split()
    texts = [
        prose(50, seed=2) + " " + passage + " " + prose(40, seed=3),
        passage.replace(" ", "\n\t") + " " + prose(30, seed=4),
        " ".join(p[:34]) + " x " + " ".join(p[34:]),
        " ".join(p[5:40]),
        prose(20, seed=5) + " " + " ".join(p[20:]),
        " ".join(p[:25] + ["y"] + p[26:]),
        "En " * 120, "En " * 35, "En " * 36 + "x", "a b c " * 40, " ".join(f"w{i % 40}" for i in range(200)),
        None, "", " \n ", passage[:30], prose(35, seed=6), prose(35, seed=6), prose(34, seed=7), prose(34, seed=7),
        "É é " * 40, " ".join(p), prose(9000, seed=8), prose(200, seed=9) + " " + " ".join(prose(9000, seed=8).split()[4000:4100]),
    ]
    pairs = list(enumerate(texts))
    check(clashing(docs_of(pairs)), pairs, 35)
    check(docs_of(pairs), pairs, 5)


def test_low_variety_texts(docs_of):
    """Anchors with many differing blocks."""
    import random
    rng = random.Random(4)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(30, 160))) for _ in range(40)]
    pairs = list(enumerate(texts))
    check(docs_of(pairs), pairs, 12)
    check(docs_of(pairs), pairs, 35)


def test_repeated_rows_null_ids_and_many_copies(docs_of, prose):
    base = prose(90, seed=11)
    pairs = [(None, base), (None, base), (7, base), (7, base), (8, prose(90, seed=12)), (None, None), (None, "")]
    pairs += [(100 + i, prose(10, seed=100 + i) + " " + base + " " + prose(10, seed=300 + i)) for i in range(60)]
    check(docs_of(pairs), pairs, 35)


def test_text_longer_than_a_chunk(docs_of):
    long = " ".join(f"word{i}" for i in range(CHUNK_BYTES // 8))
    tail = " ".join(long.split()[-50:])
    pairs = [(1, long), (2, tail), (3, "short")]
    check(docs_of(pairs), pairs, 35)


def test_full_filter_only_costs_work(docs_of, prose, monkeypatch):
    monkeypatch.setattr(substring, "FILTER_BITS", 8)
    base = prose(80, seed=21)
    pairs = [(i, prose(50, seed=400 + i) + (" " + base if i % 3 == 0 else "")) for i in range(20)]
    check(docs_of(pairs), pairs, 35)


def test_empty_table(docs_of):
    assert substring.cut_repeats(docs_of([])).count() == 0
    assert substring.cut_texts(docs_of([])).count() == 0


def test_cut_texts_keeps_columns_and_untouched_bytes(docs_of, prose, clashing):
    base, clean = prose(60, seed=31), "Left  as\tit is \n"
    docs = clashing(docs_of([(1, "head " + base), (2, base + " tail"), (3, clean), (4, None), (5, ""), (6, base)]))
    rows = {r.doc_id: r for r in substring.cut_texts(docs).collect()}
    assert substring.cut_texts(docs).columns == docs.columns
    assert {i: r.text for i, r in rows.items()} == {1: "head", 2: "tail", 3: clean, 4: None, 5: ""}
    assert rows[1].n_chars == 4 and rows[3].n_chars == len(clean)


def test_query_digest(spark, docs_of, prose, tmp_path):
    docs = docs_of([(1, "A  b"), (2, None)])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.kept_sha256 for r in substring.op5(spark, str(tmp_path)).collect()}
    assert got == {1: hashlib.sha256(b"A b").hexdigest(), 2: hashlib.sha256(b"").hexdigest()}
