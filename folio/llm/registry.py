"""The queries of this subpackage and their SQL, for the driver's entry."""

from __future__ import annotations

from folio.llm import (
    byte_bpe,
    context_mixing,
    embedding_dedup,
    ngram_join,
    oracles,
    packing,
    quality,
    substring_dedup,
    token_store,
    toxicity,
    url_rules,
)

QUERIES = {
    "op1_toxicity": toxicity.query,
    "op2_byte_bpe": byte_bpe.query,
    "op3_embedding_near_dedup": embedding_dedup.query,
    "op4_best_fit_packing": packing.query,
    "op5_ngram_jaccard_join": ngram_join.query,
    "op6_url_filters": url_rules.query,
    "op7_substring_dedup": substring_dedup.query,
    "op8_quality_rules": quality.query,
    "op9_lm_scoring": context_mixing.query,
    "op10_token_store": token_store.query,
}

ORACLES: dict[str, str] = oracles.ORACLES
