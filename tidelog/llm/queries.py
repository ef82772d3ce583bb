"""Registered queries of the corpus operators and their oracle SQL."""

from __future__ import annotations

from tidelog.llm import (
    chat_format,
    fuzzy_lines,
    html_wrapper,
    license_scan,
    ngram_join,
    packing,
    pieces,
    pq_dedup,
    prefix_trie,
    quality_rules,
    structure_repair,
    substring_dedup,
    tier_packing,
)

QUERIES = {
    "op10_fuzzy_line_dedup": fuzzy_lines.op10_fuzzy_line_dedup,
    "op1_quality_rules": quality_rules.op1_quality_rules,
    "op2_ngram_jaccard": ngram_join.op2_ngram_jaccard,
    "op3_sentencepiece": pieces.op3_sentencepiece,
    "op4_best_fit_packing": packing.op4_best_fit_packing,
    "op5_html_extraction": html_wrapper.op5_html_extraction,
    "op6_substring_dedup": substring_dedup.op6_substring_dedup,
    "op7_license_scan": license_scan.op7_license_scan,
    "op8_chat_formatting": chat_format.op8_chat_formatting,
    "op9_embedding_near_dedup": pq_dedup.op9_embedding_near_dedup,
    "op11_structure_repair": structure_repair.op11_structure_repair,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_tier_packing": tier_packing.op13_tier_packing,
}

ORACLES: dict[str, str] = {
    "op1_quality_rules": quality_rules.OP1_SQL,
    "op2_ngram_jaccard": ngram_join.OP2_SQL,
    "op11_structure_repair": structure_repair.OP11_SQL,
    "op12_prefix_trie": prefix_trie.OP12_SQL,
}
