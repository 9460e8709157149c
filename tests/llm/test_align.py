"""Cross-tokenizer alignment against the libraries and a plain merge."""
import hashlib
import json
from collections import Counter

import numpy as np
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from shopfloor.llm import align

SPECIAL = ["<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "▁", "\u0000", "a\u0000b", "  two  spaces ", "\n\n\t", "日本語のテキスト", "🙂🙃", "é", "﻿x", "don't we'll"]


@pytest.fixture(scope="module")
def files():
    return align.Files.read()


@pytest.fixture(scope="module")
def aligner(files):
    return align.Aligner(files)


@pytest.fixture(scope="module")
def libraries():
    a = tokenizers.Tokenizer.from_file(align.A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=align.B_PATH)


def brute(text, libraries):
    """(a ids, b ids, groups, links) of one text by a merge of sorted ends."""
    a, b = libraries
    letters = align.byte_of_letter()
    if not text:
        return None
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    whole = (" " + text).encode()
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return None
    groups, links, ga, gb, i, j, ea, eb = [], [], [], [], 0, 0, 0, 0
    ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]), np.cumsum([len(x) for x in bytes_b])
    while i < len(ids_a):
        if not ga or ga[-1] != i:
            ga.append(i)
        if not gb or gb[-1] != j:
            gb.append(j)
        links.append((ids_a[i], ids_b[j]))
        ea, eb = ends_a[i], ends_b[j]
        i, j = i + (ea <= eb), j + (eb <= ea)
        if ea == eb:
            groups.append(([ids_a[k] for k in ga], [ids_b[k] for k in gb]))
            ga, gb = [], []
    return ids_a, ids_b, groups, links


def written(groups):
    if not groups:
        return ""
    return hashlib.sha256(";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups).encode()).hexdigest()


def expected(pairs, libraries):
    found = [(i, brute(t, libraries)) for i, t in pairs]
    count = Counter(p for _, f in found if f for p in set(f[3]))
    highest = {}
    for (a, _), n in count.items():
        highest[a] = max(highest.get(a, 0), n)
    return sorted(((i, 0, 0, 0, 0, "", 0, 0) if f is None else (
        i, len(f[0]), len(f[1]), len(f[2]), len(f[3]), written(f[2]), sum(count[p] == highest[p[0]] for p in f[3]), sum(count[p] for p in f[3]))
        for i, f in found), key=str)


def test_side_a_equals_the_library(aligner, libraries, prose):
    assert aligner.side_a.plain
    texts = SPECIAL + [prose(300, seed=1)]
    for t, ids in zip(texts, aligner.side_a.encode(texts)):
        assert ids.tolist() == libraries[0].encode(t, add_special_tokens=False).ids


def test_a_file_of_another_kind_is_left_to_the_library(files):
    spec = json.loads(files.a)
    spec["pre_tokenizer"]["add_prefix_space"] = True
    side = align.ByteLevel(json.dumps(spec))
    assert not side.plain
    assert side.encode(["word"])[0].tolist() == align.ByteLevel(files.a).encode([" word"])[0].tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60) | st.sampled_from(SPECIAL), max_size=6))
def test_blocks_equal_a_plain_merge(texts):
    files = align.Files.read()
    aligner = _HELD.setdefault("aligner", align.Aligner(files))
    libraries = _HELD.get("libraries")
    if libraries is None:
        a = tokenizers.Tokenizer.from_file(align.A_PATH)
        a.encode_special_tokens = True
        libraries = _HELD["libraries"] = (a, sentencepiece.SentencePieceProcessor(model_file=align.B_PATH))
    block = aligner.align([t.encode() for t in texts])
    a, b = block.group_lists()
    first, link_a, link_b = block.links()
    for t, text in enumerate(texts):
        want = brute(text, libraries) or ([], [], [], [])
        assert list(zip(a[t], b[t])) == [(x, y) for x, y in want[2]]
        assert list(zip(link_a[first[t] : first[t + 1]].tolist(), link_b[first[t] : first[t + 1]].tolist())) == want[3]
        assert first[t + 1] - first[t] == len(want[0]) + len(want[1]) - len(want[2])
    assert aligner.digests(block) == [written((brute(t, libraries) or ([], [], [], []))[2]) for t in texts]


_HELD: dict = {}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 40), st.sets(st.integers(1, 39)), st.sets(st.integers(1, 39))), min_size=1, max_size=4))
def test_cuts_of_any_two_segmentations(texts):
    ends_a, ends_b, first_a, first_b, base, want = [], [], [0], [0], 0, set()
    for size, a, b in texts:
        a, b = {x for x in a if x < size} | {size}, {x for x in b if x < size} | {size}
        want |= {base + x for x in a & b}
        ends_a += sorted(base + x for x in a)
        ends_b += sorted(base + x for x in b)
        first_a.append(len(ends_a))
        first_b.append(len(ends_b))
        base += size
    ends_a, ends_b = np.array(ends_a), np.array(ends_b)
    cut_a, cut_b = align.shared_cuts(ends_a, ends_b, np.array(first_a), np.array(first_b))
    assert ends_a[cut_a - 1].tolist() == ends_b[cut_b - 1].tolist() == sorted(want)


@pytest.mark.parametrize("block_bytes", [200, 1 << 21])
def test_scores_equal_brute_force(spark, docs_of, clashing, prose, files, libraries, block_bytes):
    pairs = [(i, prose(60, seed=i) + " Häuser don't <|endoftext|>") for i in range(25)]
    pairs += [(100 + i, t) for i, t in enumerate(SPECIAL)] + [(None, "no id"), (3, pairs[3][1]), (3, pairs[3][1]), (200, None), (201, ""), (202, prose(9000, seed=9))]
    got = align.link_scores(clashing(docs_of(pairs)), files, block_bytes=block_bytes).collect()
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")
    assert sorted((tuple(r[c] for c in columns) for r in got), key=str) == expected(pairs, libraries)
    assert any(r.n_a == 0 and r.doc_id not in (200, 201) for r in got)  # a text that side B does not keep


def test_groups_hold_all_ids(spark, docs_of, prose, files, libraries):
    pairs = [(1, prose(200, seed=1)), (2, None), (None, "x")]
    for r in align.groups(docs_of(pairs), files).collect():
        want = brute(dict(pairs)[r.doc_id], libraries)
        assert list(zip(r.a_groups, r.b_groups)) == ([] if want is None else want[2])


def test_empty_table(spark, docs_of, files):
    assert align.link_scores(docs_of([]), files).count() == 0
