"""The registered queries of this package and their SQL twins."""

from __future__ import annotations

from . import (byte_bpe, language_id, lm_score, main_text, merkle, mixing, near_dedup, quality_rules, search, sharding, token_counts,
               toxicity, vector_dedup)

_MODULES = {
    "op1_lm_score": (lm_score.op1_lm_score, lm_score.ORACLE_SQL),
    "op2_language_id": (language_id.op2_language_id, language_id.ORACLE_SQL),
    "op3_sharding": (sharding.op3_sharding, sharding.ORACLE_SQL),
    "op4_main_text": (main_text.op4_main_text, main_text.ORACLE_SQL),
    "op5_vector_dedup": (vector_dedup.op5_vector_dedup, vector_dedup.ORACLE_SQL),
    "op6_mixing": (mixing.op6_mixing, mixing.ORACLE_SQL),
    "op7_toxicity": (toxicity.op7_toxicity, toxicity.ORACLE_SQL),
    "op8_byte_bpe": (byte_bpe.op8_byte_bpe, byte_bpe.ORACLE_SQL),
    "op9_quality_rules": (quality_rules.op9_quality_rules, quality_rules.ORACLE_SQL),
    "op10_near_dedup": (near_dedup.op10_near_dedup, near_dedup.ORACLE_SQL),
    "op11_lexical_search": (search.op11_lexical_search, search.ORACLE_SQL),
    "op12_token_counts": (token_counts.op12_token_counts, token_counts.ORACLE_SQL),
    "op13_merkle_manifest": (merkle.op13_merkle_manifest, merkle.ORACLE_SQL),
}


def queries() -> dict:
    return {k: f for k, (f, _) in _MODULES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for k, (_, s) in _MODULES.items() if s}
