"""The corpus operators' registered queries, and SQL for those that SQL can express."""

from __future__ import annotations

from . import conversation_repair, decontamination, fill_in_middle, html_extraction, language, line_dedup, mixing, ngram_jaccard, pii, quality, substring_dedup, token_output, warc

QUERIES = {
    "op1_substring_dedup": substring_dedup.query,
    "op2_ngram_jaccard": ngram_jaccard.query,
    "op3_token_output": token_output.query,
    "op4_html_extraction": html_extraction.query,
    "op5_line_dedup": line_dedup.query,
    "op6_mixing": mixing.query,
    "op7_language": language.query,
    "op8_decontamination": decontamination.query,
    "op9_pii": pii.query,
    "op10_quality": quality.query,
    "op11_conversation_repair": conversation_repair.query,
    "op12_fill_in_middle": fill_in_middle.query,
    "op13_warc": warc.query,
}
ORACLES = {
    "op1_substring_dedup": substring_dedup.SQL,
    "op2_ngram_jaccard": ngram_jaccard.SQL,
    "op5_line_dedup": line_dedup.SQL,
    "op6_mixing": mixing.SQL,
    "op11_conversation_repair": conversation_repair.SQL,
    "op12_fill_in_middle": fill_in_middle.SQL,
    "op13_warc": warc.SQL,
}
