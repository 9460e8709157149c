"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import align, ann, chat, decontam, exact_stream, lang_id, licenses, lm_score, pieces, quality, simhash, spelling, substring

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lang_id": lang_id.op1,
    "op2_decontamination": decontam.op2,
    "op3_chat_format": chat.op3,
    "op4_pieces": pieces.op4,
    "op5_substring_dedup": substring.op5,
    "op6_nearest": ann.op6,
    "op7_lm_score": lm_score.op7,
    "op8_licenses": licenses.op8,
    "op9_simhash": simhash.op9,
    "op10_quality": quality.op10,
    "op11_exact_dedup": exact_stream.op11,
    "op12_token_alignment": align.op12,
    "op13_spelling_variants": spelling.op13,
}

#: The others have no SQL form: zstandard, pieces, approximate search, hashed
#: models, XXH64, fitted weights and tokenizers. Their tests compare them with brute force,
#: the library, or held-out rows.
ORACLE_SQL: dict[str, str] = {
    "op2_decontamination": decontam.OP2_SQL,
    "op3_chat_format": chat.OP3_SQL,
    "op5_substring_dedup": substring.OP5_SQL,
    "op8_licenses": licenses.OP8_SQL,
    "op11_exact_dedup": exact_stream.OP11_SQL,
    "op13_spelling_variants": spelling.OP13_SQL,
}
