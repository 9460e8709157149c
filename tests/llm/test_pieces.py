import random

import numpy as np
import pytest
import sentencepiece

from shopfloor.llm import pieces
from shopfloor.llm.common import read_table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.load(pieces.MODEL_PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_PATH)


def odd_texts():
    rng = random.Random(1)
    alphabet = "etaoinshrdlucmfwypvbgkjqxzETAOIN .,!#0123456789\n\téüñ日"
    texts = ["", " ", "  a b\n c\tx　ﬁ ½ ", "the    quick" + " " * 37 + "fox", "日本語のテキスト", "😀 e 😀😀", "a" * 3000, "-" * 40, "\x00", "<s> </s> <0x41>", "ab" * 300]
    return texts + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 80))) for _ in range(600)]


def test_bpe_equals_the_library(vocabulary, library):
    encoder, decoder, texts = pieces.Encoder(vocabulary), pieces.Decoder(vocabulary), odd_texts()
    for text, ids in zip(texts, encoder.encode_batch(texts, {})):
        assert ids.tolist() == library.encode(text)
        assert decoder.decode(ids) == text


def test_decoder_equals_the_library_on_any_ids(vocabulary, library):
    rng, decoder = random.Random(3), pieces.Decoder(vocabulary)
    for _ in range(300):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(259, 32000)]) for _ in range(rng.randint(1, 12))]
        assert decoder.decode(np.array(ids)) == library.decode(ids)


def best_score(word, scores, unknown):
    """Plain Viterbi over one word."""
    best = [0.0] + [None] * len(word)
    for j in range(1, len(word) + 1):
        options = [best[i] + scores[word[i:j]] for i in range(j) if word[i:j] in scores]
        if word[j - 1] not in scores:
            options.append(best[j - 1] + unknown)
        best[j] = max(options)
    return best[-1]


@pytest.mark.parametrize("with_bytes", [False, True])
def test_unigram_paths_are_the_best(with_bytes):
    rng = random.Random(5)
    own = ["<unk>", "<s>", "</s>"] + ([f"<0x{b:02X}>" for b in range(256)] if with_bytes else [])
    start = len(own)
    words = {"▁", "a", "b", "c"} | {"".join(rng.choice("abc▁") if k == 0 else rng.choice("abc") for k in range(rng.randint(1, 5))) for _ in range(60)}
    own += sorted(words)
    scores = [0.0] * start + [-rng.uniform(1, 9) for _ in own[start:]]
    v = pieces.Vocabulary(own, scores, "unigram", 0, {0, 1, 2}, {b: 3 + b for b in range(256)} if with_bytes else {})
    encoder = pieces.Encoder(v)
    table = dict(zip(own[start:], scores[start:]))
    words = ["▁" * rng.randint(0, 2) + "".join(rng.choice("abcd") for _ in range(rng.randint(1, 14))) for _ in range(300)]
    for word, ids in encoder.encode_words(sorted(set(words))).items():
        total, text, at = 0.0, "", 0
        for i in np.frombuffer(ids, dtype=np.int32).tolist():
            if i >= start:
                total += scores[i]
                text += own[i]
        missing = [c for c in word if c not in table]
        assert text == "".join(c for c in word if c in table) or missing
        assert total + encoder.unknown_score * len(missing) == pytest.approx(best_score(word, table, encoder.unknown_score))
    ids = encoder.encode_batch(["dd d a"], {})[0].tolist()
    assert (0 in ids) == (not with_bytes)


def test_whole_table_round_trips(spark, library):
    rows = pieces.op4(spark, SF).collect()
    assert len(rows) == 1000 and all(r.round_trip for r in rows)
    some = {r.doc_id: r.text for r in read_table(spark, SF, "documents").where("doc_id % 50 = 0").collect()}
    counts = {r.doc_id: r.n_ids for r in rows}
    assert all(counts[i] == len(library.encode(t)) for i, t in some.items())


def test_odd_rows(spark, docs_of, clashing, vocabulary, library):
    long = "word " * 60_000 + "x" * 50_000
    docs = clashing(docs_of([(1, None), (2, ""), (3, long), (3, long), (None, "no id"), (5, "▁")]))
    coded = pieces.encode(docs, vocabulary)
    rows = coded.collect()
    assert len(rows) == 6 and [list(r.ids) for r in rows if r.c0 in (1, 2)] == [[], []]
    assert {tuple(r.ids) for r in rows if r.c0 == 3} == {tuple(library.encode(long))}
    named = coded.select("c0", "ids")
    back = {r.c0: r.decoded for r in pieces.decode(named, vocabulary).collect()}
    assert back[1] == "" and back[3] == long and back[None] == "no id"
    assert back[5] == " "  # the white space mark itself reads as white space
    assert pieces.encode(docs_of([]), vocabulary).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, [])], "k int, ids array<int>")
    assert [r.decoded for r in pieces.decode(nulls, vocabulary).collect()] == ["", ""]


def test_small_caches_change_nothing(vocabulary, library, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_WORDS", 5)
    encoder, cache = pieces.Encoder(vocabulary), {}
    texts = odd_texts()[:60]
    for lo in range(0, 60, 7):
        for text, ids in zip(texts[lo:lo + 7], encoder.encode_batch(texts[lo:lo + 7], cache)):
            assert ids.tolist() == library.encode(text)
