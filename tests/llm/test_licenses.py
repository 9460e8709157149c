import re

from shopfloor.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
MIT = next(t for t, label in licenses.NOTICES.items() if label == "mit-grant")


def plain(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places = []
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        places += [(label, i) for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
    return len(words), sorted(places)


def test_base_places_match_brute_force(docs_of, prose, clashing):
    texts = [
        "MIT License", "The MIT-License, the Apache License 2.0 and MIT license.", "mit mit license license", "CC BY CC-BY cc by-sa",
        "gnu general public license gnu GNU General Public License", "gnu general public", "general public license", "", None, " ", "mit",
        "KMIT License", "mİt license MIT license", "MİT license", "license mit\nlicense", prose(3000, seed=1) + " apache license " + prose(10, seed=2),
        "cc by " * 500, "apache é license", "apacheé license",
    ]
    pairs = list(enumerate(texts))
    got = {r.doc_id: (r.n_words, sorted((p.label, p.start) for p in r.places)) for r in licenses.scan(clashing(docs_of(pairs))).collect()}
    assert got == {i: plain(t) for i, t in pairs}


def test_notices_with_gaps(docs_of):
    words = MIT.split()
    near = " ".join(words[:7] + ["EXTRA"] + words[7:])
    pairs = [(1, MIT.upper()), (2, "x y z " + near + " end"), (3, " ".join(words[:6])), (4, "nothing here"), (5, " ".join(reversed(words)))]
    rows = {r.doc_id: r for r in licenses.scan(docs_of(pairs)).collect()}
    def clear(row):
        return [n for n in row.notices if n.share >= licenses.NOTICE_SHARE]
    assert [(n.label, n.start, n.n, n.share) for n in clear(rows[1])] == [("mit-grant", 0, len(words), 1.0)] and rows[1].score == 1.0
    (two,) = clear(rows[2])
    assert (two.label, two.start, two.n) == ("mit-grant", 3, len(words) + 1) and 0.9 < two.share < 1
    assert 0 < rows[3].score < licenses.NOTICE_SHARE and rows[4].score == 0 and rows[4].notices == []


def test_repeated_rows_and_empty_table(docs_of):
    assert licenses.scan(docs_of([])).count() == 0
    rows = licenses.scan(docs_of([(1, "MIT license"), (1, "MIT license"), (1, "other"), (None, "cc by"), (None, None)])).collect()
    assert sorted((str(r.doc_id), r.n_words, len(r.places)) for r in rows) == [("1", 1, 0), ("1", 2, 1), ("1", 2, 1), ("None", 0, 0), ("None", 2, 1)]
