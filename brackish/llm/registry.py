"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from . import chat_format, decontam, html_extract, line_dedup, lm_score, mixing, quality, simhash, substring_dedup, toxicity

QUERIES = {
    "op1_source_mixing": mixing.query,
    "op2_toxicity": toxicity.query,
    "op3_html_extraction": html_extract.query,
    "op4_quality_rules": quality.query,
    "op5_line_dedup": line_dedup.query,
    "op6_decontamination": decontam.query,
    "op7_simhash": simhash.query,
    "op8_lm_scoring": lm_score.query,
    "op9_chat_formatting": chat_format.query,
    "op10_substring_dedup": substring_dedup.query,
}

#: DuckDB SQL for the queries that SQL expresses; the others are tested against brute force in tests/llm.
ORACLES = {
    "op1_source_mixing": mixing.sql(),
    "op9_chat_formatting": chat_format.sql(),
}
