"""The queries of this subpackage by name, and the SQL of those that have an exact SQL form."""

from __future__ import annotations

from llm import (
    blocklist,
    decontaminate,
    html,
    line_dedup,
    merkle,
    mixing,
    neighbours,
    ngram_join,
    quality,
    repair,
    substring_dedup,
    suffix_dedup,
    toxicity,
)

_QUERIES = (
    ngram_join.op1_ngram_join,
    html.op2_html_extraction,
    blocklist.op3_url_filters,
    substring_dedup.op4_substring_dedup,
    quality.op5_quality_rules,
    toxicity.op6_toxicity,
    mixing.op7_mixing,
    decontaminate.op8_decontamination,
    line_dedup.op9_line_dedup,
    suffix_dedup.op10_suffix_dedup,
    neighbours.op11_nearest_neighbours,
    repair.op12_conversation_repair,
    merkle.op13_merkle_manifest,
)

QUERIES = {query.__name__: query for query in _QUERIES}

SQL = {
    "op3_url_filters": blocklist.SQL,
    "op7_mixing": mixing.SQL,
    "op12_conversation_repair": repair.SQL,
    "op13_merkle_manifest": merkle.SQL,
}
