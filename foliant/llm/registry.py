"""The queries of this subpackage and, where SQL can express them, their DuckDB twins."""

from . import chat_format, ctw, exact_dedup, html_extract, line_dedup, ngram_join, packing, prefix_trie, quality_rules, source_mix, suffix_dedup, url_filter, whitening

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_lm_score": ctw.op3_lm_score,
    "op4_source_mix": source_mix.op4_source_mix,
    "op5_quality_rules": quality_rules.op5_quality_rules,
    "op6_chat_format": chat_format.op6_chat_format,
    "op7_packing": packing.op7_packing,
    "op8_url_filter": url_filter.op8_url_filter,
    "op9_ngram_join": ngram_join.op9_ngram_join,
    "op10_html_extract": html_extract.op10_html_extract,
    "op11_suffix_dedup": suffix_dedup.op11_suffix_dedup,
    "op12_whitening": whitening.op12_whitening,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}
ORACLES = {
    "op9_ngram_join": ngram_join.ORACLE,
    "op6_chat_format": chat_format.ORACLE,
    "op1_line_dedup": line_dedup.ORACLE,
    "op2_exact_dedup": exact_dedup.ORACLE,
    "op5_quality_rules": quality_rules.ORACLE,
    "op8_url_filter": url_filter.ORACLE,
    "op11_suffix_dedup": suffix_dedup.ORACLE,
    "op13_prefix_trie": prefix_trie.ORACLE,
}
