import re

from pyspark.sql import functions as F

from shopfloor.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(text, bench, window=13):
    words, hit, items = words_of(text), set(), set()
    for item, body in bench:
        own = words_of(body)
        m = min(window, len(own))
        grams = {tuple(own[i:i + m]) for i in range(len(own) - m + 1)} if m else set()
        for i in range(len(words) - m + 1 if m else 0):
            if tuple(words[i:i + m]) in grams:
                hit.update(range(i, i + m))
                if item is not None:
                    items.add(str(item))
    return len(words), len(hit), sorted(items)


def check(spark, docs, pairs, bench, **more):
    table = spark.createDataFrame(bench, "item_id long, text string")
    rows = decontam.search(docs, table, **more).select("c0", "n_words", "n_hit", "items", "spans").collect()
    got = sorted((str(r.c0), r.n_words, r.n_hit, tuple(r["items"])) for r in rows)
    assert got == sorted((str(i), n, h, tuple(it)) for i, (n, h, it) in ((i, plain(t, bench)) for i, t in pairs))
    assert all(sum(s.n for s in r.spans) == r.n_hit for r in rows)


def cases(prose):
    long = prose(60, seed=1)
    w = long.split()
    bench = [(10, long), (9, " ".join(w[20:40]) + " and more " + prose(20, seed=2)), (2, "Short item, three!"), (3, "one"),
             (4, ""), (5, None), (None, prose(15, seed=3)), (6, "É à ü"), (7, long), (100, prose(13, seed=4))]
    texts = [
        prose(200, seed=5) + " " + long.upper().replace(" ", ", ") + " " + prose(100, seed=6),
        " ".join(w[3:16]), " ".join(w[3:15]), "x " + " ".join(w[30:43]) + " y " + " ".join(w[10:23]),
        "a short -- ITEM... three", "short item", "one", "One two ONE", "", None, " .. ", "é à ü", "É à ü É à ü",
        prose(13, seed=4), prose(15, seed=3) * 2, prose(4000, seed=7) + " " + long, "<|im_end|> " + long + "\x00" + long,
    ]
    return list(enumerate(texts)), bench


def test_matches_brute_force(spark, docs_of, prose, clashing):
    pairs, bench = cases(prose)
    check(spark, clashing(docs_of(pairs)), pairs, bench)


def test_blocks_of_a_large_benchmark(spark, docs_of, prose):
    pairs, bench = cases(prose)
    pairs = pairs + pairs[:3] + [(None, pairs[0][1]), (None, None)]
    check(spark, docs_of(pairs), pairs, bench, bench_bytes=150)


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    row = decontam.search(docs_of([(1, "some words")]), none).first()
    assert (row.n_words, row.n_hit, row["items"], row.spans) == (2, 0, [], [])
    assert decontam.search(docs_of([]), none).count() == 0


def test_rule_and_kept_columns(spark, docs_of, prose, clashing):
    item = prose(13, seed=40)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    pairs = [(1, item + " " + prose(247, seed=41)), (2, item + " " + prose(248, seed=42)), (3, None), (4, "")]
    docs = clashing(docs_of(pairs))
    kept = decontam.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]


def test_tables_skip_and_confirm():
    """A wrong hash bucket is no occurrence: words are compared directly."""
    (tables,) = decontam.build([("a", "p q r s")], 4)
    assert tables.shift.max() == 3 and (tables.shift == 0).sum() >= 1
    tables.whole[:] = 0
    chunk = decontam.Chunk(0, decontam.LOWER[__import__("numpy").frombuffer(b"p q r s", dtype="uint8")], __import__("numpy").array([0, 7]), decontam.ALNUM)
    assert len(tables.search(chunk, chunk.word_hashes())[0]) == 0
