"""Registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from opinionmill.llm import (
    alignment, chat, ctw, jaccard, minhash, neighbours, packing, pieces, quality, secrets, substrings, toxicity, variants,
)

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_quality_rules": quality.op2_quality_rules,
    "op3_minhash_duplicates": minhash.op3_minhash_duplicates,
    "op4_nearest_neighbours": neighbours.op4_nearest_neighbours,
    "op5_chat_format": chat.op5_chat_format,
    "op6_sentencepiece": pieces.op6_sentencepiece,
    "op7_suffix_dedup": substrings.op7_suffix_dedup,
    "op8_best_fit_packing": packing.op8_best_fit_packing,
    "op9_secret_scan": secrets.op9_secret_scan,
    "op10_context_tree_weighting": ctw.op10_context_tree_weighting,
    "op11_token_alignment": alignment.op11_token_alignment,
    "op12_spelling_variants": variants.op12_spelling_variants,
    "op13_ngram_join": jaccard.op13_ngram_join,
}

ORACLES = {
    "op5_chat_format": chat.OP5_SQL,
    "op9_secret_scan": secrets.OP9_SQL,
}
