"""The operators' queries and, where SQL can express them, their SQL."""

from __future__ import annotations

from tessera.llm import bpe, conversations, exact_dedup, licenses, mixing, ngram_join, pieces, quality, secrets, substring_dedup, suffix_dedup, token_counts, vectors


def queries():
    return {
        "op1_exact_dedup": exact_dedup.op1_exact_dedup,
        "op2_byte_bpe": bpe.op2_byte_bpe,
        "op3_ngram_jaccard_join": ngram_join.op3_ngram_jaccard_join,
        "op4_quality_rules": quality.op4_quality_rules,
        "op5_substring_dedup": substring_dedup.op5_substring_dedup,
        "op6_mix_sources": mixing.op6_mix_sources,
        "op7_token_counts": token_counts.op7_token_counts,
        "op8_license_scan": licenses.op8_license_scan,
        "op9_secret_scan": secrets.op9_secret_scan,
        "op10_suffix_array_dedup": suffix_dedup.op10_suffix_array_dedup,
        "op11_sentencepiece": pieces.op11_sentencepiece,
        "op12_conversation_trie": conversations.op12_conversation_trie,
        "op13_vector_codes": vectors.op13_vector_codes,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": exact_dedup.SQL,
        "op3_ngram_jaccard_join": ngram_join.SQL,
        "op5_substring_dedup": substring_dedup.SQL,
        "op6_mix_sources": mixing.SQL,
        "op12_conversation_trie": conversations.SQL,
        "op13_vector_codes": vectors.SQL,
    }
