"""Language identification by compression: a text belongs to the language
whose raw-content zstandard dictionary compresses it best."""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table

UNDETERMINED = "und"

#: Characters of a training piece (longer texts are cut into such pieces), and
#: dictionary bytes of a language. A draw holds DRAW times that, as an
#: expectation over distinct pieces; languages that it leaves short are drawn again.
TRAIN_PIECE_CHARS = 16 << 10
DICTIONARY_BYTES = 110_000
DRAW = 1.5

#: Dictionaries that a task has open at a time; more languages go block by block.
LANGUAGES = 200

#: Whole texts are compressed in pieces, so that a long text leans on the
#: dictionary throughout and not on what it said before.
PIECE_CHARS = 2000
LEVEL = 6

#: Saved bytes by which the best language must lead for the text to be accepted.
MARGIN_BYTES = 4

#: Word characters that are neither letters nor decimal digits: superscripts, fractions, Roman numerals and other number signs.
_NUMBER_SIGNS = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isalpha() and not c.isdecimal())
_SPACED = dict.fromkeys(map(ord, _NUMBER_SIGNS), " ")
#: Finds a number sign or any character beyond U+FFFF. Those are one range: a
#: class tries what it holds beyond U+FFFF one by one for every character.
_MAYBE_NUMBER_SIGN = re.compile(f"[{''.join(c for c in _NUMBER_SIGNS if c <= '\uffff')}\U00010000-\U0010ffff]")
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_NOT_ASCII_LETTERS = re.compile("[^a-z]+")


def letters(text: str | None) -> str:
    """Lower-case words of letters, joined by single spaces."""
    if not text:
        return ""
    low = text.lower()
    if low.isascii():
        return _NOT_ASCII_LETTERS.sub(" ", low).strip()
    if _MAYBE_NUMBER_SIGN.search(low):
        low = low.translate(_SPACED)
    return _NOT_LETTERS.sub(" ", low).strip()


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> dict[str, bytes]:
    """Dictionaries of every language, most frequent first, from a sample of
    the labelled rows: distinct pieces of texts chosen by hash, drawn until the
    dictionary is full or the language is used up. The driver holds
    DICTIONARY_BYTES a language."""
    lang, text = F.col(f"`{lang_col}`").cast("string"), F.col(f"`{text_col}`")
    rows = docs.select(lang.alias("lang"), text.alias("text")).where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    cut = F.regexp_extract_all("text", F.lit(f"(?s)(.{{1,{TRAIN_PIECE_CHARS}}})"), F.lit(1))
    pieces = rows.select("lang", F.posexplode(F.when(F.octet_length("text") <= TRAIN_PIECE_CHARS, F.array("text")).otherwise(cut)).alias("at", "text"))
    once = pieces.groupBy("lang", F.xxhash64("text").alias("hash")).agg(
        F.count_if(F.col("at") == 0).alias("texts"), F.max(F.octet_length("text")).alias("bytes"))
    known = once.groupBy("lang").agg(F.sum("texts").alias("texts"), F.sum("bytes").alias("bytes")).orderBy(F.desc("texts"), "lang").collect()
    learned: dict[str, bytes] = {r["lang"]: b"" for r in known}
    # A language's sample is the same share of its hash space on every machine.
    space, times, short = 1 << 30, DRAW, known
    spot = F.pmod(F.xxhash64("text"), F.lit(space))
    while short:
        share = {r["lang"]: min(1.0, times * DICTIONARY_BYTES / r["bytes"]) for r in short}
        limits = docs.sparkSession.createDataFrame([(k, int(space * v)) for k, v in share.items()], "lang string, below long")
        drawn = pieces.join(F.broadcast(limits), "lang").where(spot < F.col("below")).select("lang", "text").distinct()
        texts, held = {k: [] for k in share}, dict.fromkeys(share, 0)
        for row in drawn.orderBy("lang", F.xxhash64("text"), "text").toLocalIterator():
            if held[row["lang"]] < DICTIONARY_BYTES and (plain := letters(row["text"])):
                texts[row["lang"]].append(plain)
                held[row["lang"]] += len(plain.encode()) + 1
        for name, own in texts.items():
            learned[name] = " ".join(own).encode()[:DICTIONARY_BYTES]
        short = [r for r in short if share[r["lang"]] < 1 and len(learned[r["lang"]]) < DICTIONARY_BYTES]
        times *= 4
    return learned


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.names = list(dictionaries)
        self.compressors = []
        for content in dictionaries.values():
            shared = zstandard.ZstdCompressionDict(content or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            shared.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=shared, write_content_size=False, write_checksum=False, write_dict_id=False))

    def sizes(self, text: str) -> list[int]:
        """Compressed bytes of a text of letters under each language."""
        pieces = [text[i : i + PIECE_CHARS].encode() for i in range(0, len(text), PIECE_CHARS)]
        return [sum(len(c.compress(p)) for p in pieces) for c in self.compressors]

    def rank(self, plain: str) -> tuple[int, int, float, float]:
        """(fewest bytes, its language's place, next fewest, all languages'
        weight against the best) of a text of letters."""
        sizes = self.sizes(plain)
        best = min(sizes)
        at = sizes.index(best)
        rest = sizes[:at] + sizes[at + 1 :]
        return best, at, min(rest, default=math.inf), 1.0 + sum(math.exp((best - s) / 2) for s in rest)


def merge(one: tuple[int, int, float, float], two: tuple[int, int, float, float]) -> tuple[int, int, float, float]:
    """The rank over both blocks; a tie goes to the first."""
    won, lost = (two, one) if two[0] < one[0] else (one, two)
    return won[0], won[1], min(won[2], lost[0]), won[3] + lost[3] * math.exp((won[0] - lost[0]) / 2)


def predict(texts: list[str | None], dictionaries: dict[str, bytes], opened: dict[int, Classifier]) -> list[tuple[str, float, int]]:
    """(language, score, lead in bytes) by text. The score shares out belief by
    the compressed sizes; ties go to the more frequent language. ``opened``
    keeps the classifier of the last block of languages."""
    names = list(dictionaries)
    plain = [letters(t) for t in texts]
    ranks: list[tuple[int, int, float, float] | None] = [None] * len(plain)
    for lo in range(0, len(names), LANGUAGES):
        if lo not in opened:
            opened.clear()
            opened[lo] = Classifier({n: dictionaries[n] for n in names[lo : lo + LANGUAGES]})
        for i, text in enumerate(plain):
            if text:
                best, at, after, weight = opened[lo].rank(text)
                found = best, lo + at, after, weight
                ranks[i] = found if ranks[i] is None else merge(ranks[i], found)
    return [(UNDETERMINED, 0.0, 0) if r is None else
            (names[r[1]], 1.0 / r[3], MARGIN_BYTES if r[2] == math.inf else int(r[2]) - r[0]) for r in ranks]


def identify(docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, lead, accepted) of every whole text.

    Null texts and texts without letters are `und` with score 0 and are not
    accepted; so is everything if no language was learned. A text whose lead is
    under MARGIN_BYTES keeps its best language but is not accepted. Only the
    text is looked at; repeated rows stay repeated; ids may be null.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict[int, Classifier] = {}
        for batch in batches:
            found = predict([t.as_py() for t in batch.column(1)], held.value, opened)
            lead = [f[2] for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                 pa.array(lead, pa.int64()), pa.array([f[0] != UNDETERMINED and n >= MARGIN_BYTES for f, n in zip(found, lead)], pa.bool_())],
                ["doc_id", "lang_pred", "score", "lead", "accepted"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double, lead long, accepted boolean")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs.where(~held_out(F.col("doc_id"))))
    return identify(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "lead", "accepted")
