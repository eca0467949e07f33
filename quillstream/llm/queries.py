"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from quillstream.llm import ann, exact_dedup, filter_audit, html_text, jaccard_join, lexical_search, lm_scoring, packing, quality, sentencepiece_codec, substring_dedup, suffix_dedup, warc

QUERIES = {
    "op1_sentencepiece": sentencepiece_codec.op1_sentencepiece,
    "op2_quality": quality.op2_quality,
    "op3_jaccard_join": jaccard_join.op3_jaccard_join,
    "op4_packing": packing.op4_packing,
    "op5_html_text": html_text.op5_html_text,
    "op6_substring_dedup": substring_dedup.op6_substring_dedup,
    "op7_lm_scoring": lm_scoring.op7_lm_scoring,
    "op8_ann": ann.op8_ann,
    "op9_warc": warc.op9_warc,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_suffix_dedup": suffix_dedup.op11_suffix_dedup,
    "op12_filter_audit": filter_audit.op12_filter_audit,
    "op13_lexical_search": lexical_search.op13_lexical_search,
}

ORACLE = {
    "op3_jaccard_join": jaccard_join.SQL,
    "op5_html_text": html_text.SQL,
    "op6_substring_dedup": substring_dedup.SQL,
    "op9_warc": warc.SQL,
    "op10_exact_dedup": exact_dedup.SQL,
    "op11_suffix_dedup": suffix_dedup.SQL,
    "op12_filter_audit": filter_audit.SQL,
    "op13_lexical_search": lexical_search.SQL,
}
