"""Language identification against plain loops: dictionary, sizes and argmin per text."""

import math

import zstandard

from shopfloor.llm import lang_id

MODEL = {"en": b"the cat and the dog of that house with this door " * 40, "de": b"der hund und die katze ist nicht mit ein haus " * 40,
         "fr": "le chien et la maison n’est pas avec une porte été ".encode() * 40, "xx": b""}
TEXTS = ["the dog and the cat", "Der Hund IST nicht mit", "la maison avec une porte été", "", None, "12 ² ½ Ⅷ !?", "q", "the " * 3000 + "der hund " * 400,
         "ÉTÉ_et2la-maison", "zzzz qqqq", "中文 the"]


def plain_words(text):
    out = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    return " ".join(out.split())


def by_loops(text):
    words = plain_words(text)
    if not words:
        return "und", 0.0, 0
    sizes = {}
    for name, content in MODEL.items():
        shared = zstandard.ZstdCompressionDict(content or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        shared.precompute_compress(level=lang_id.LEVEL)
        packer = zstandard.ZstdCompressor(level=lang_id.LEVEL, dict_data=shared, write_content_size=False, write_checksum=False, write_dict_id=False)
        sizes[name] = 0
        for start in range(0, len(words), lang_id.PIECE_CHARS):
            sizes[name] += len(packer.compress(words[start:start + lang_id.PIECE_CHARS].encode()))
    best = min(sizes, key=sizes.get)  # the first of equals
    others = [n for name, n in sizes.items() if name != best]
    return best, 1 / (1 + sum(math.exp((sizes[best] - n) / 2) for n in others)), min(others) - sizes[best]


def test_predictions_equal_plain_loops(monkeypatch):
    for block in (200, 3, 1):
        monkeypatch.setattr(lang_id, "LANGUAGES", block)
        for text, (name, score, lead) in zip(TEXTS, lang_id.predict(TEXTS, MODEL, {})):
            want = by_loops(text)
            assert (name, lead) == (want[0], want[2]) and math.isclose(score, want[1], rel_tol=1e-9), text
