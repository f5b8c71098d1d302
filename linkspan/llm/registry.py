"""Queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from . import ann, bpe, chat, langid, linededup, mixing, ngramjoin, oracles, pii, quality, tokenbin

QUERIES = {
    "op4_nearest": ann.op4_nearest,
    "op5_language_id": langid.op5_language_id,
    "op6_chat_format": chat.op6_chat_format,
    "op2_ngram_jaccard": ngramjoin.op2_ngram_jaccard,
    "op1_mixing": mixing.op1_mixing,
    "op10_line_dedup": linededup.op10_line_dedup,
    "op3_pii": pii.op3_pii,
    "op7_token_files": tokenbin.op7_token_files,
    "op9_byte_bpe": bpe.op9_byte_bpe,
    "op8_quality_rules": quality.op8_quality_rules,
}

ORACLE = {
    "op2_ngram_jaccard": oracles.OP2,
    "op8_quality_rules": oracles.OP8,
    "op10_line_dedup": oracles.OP10,
}
