"""Queries of the operators by name, and comparison SQL where SQL can express one."""

from __future__ import annotations

from stallwise.llm import (
    decontamination,
    hard_negatives,
    jaccard_join,
    language_id,
    lexical_scan,
    line_dedup,
    secret_scan,
    simhash_near,
    simhash_tables,
    source_mix,
    substring_dedup,
    token_blocks,
    url_filter,
)

QUERIES = {
    "op1_substring_dedup": substring_dedup.op1_substring_dedup,
    "op2_url_filter": url_filter.op2_url_filter,
    "op3_token_output": token_blocks.op3_token_output,
    "op4_fingerprints": simhash_tables.op4_fingerprints,
    "op5_decontamination": decontamination.op5_decontamination,
    "op6_language_id": language_id.op6_language_id,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op8_secret_scan": secret_scan.op8_secret_scan,
    "op9_simhash_near_dedup": simhash_near.op9_simhash_near_dedup,
    "op10_source_mix": source_mix.op10_source_mix,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_jaccard_join": jaccard_join.op12_jaccard_join,
    "op13_lexical_search": lexical_scan.op13_lexical_search,
}

ORACLE_SQL = {
    "op2_url_filter": url_filter.OP2_SQL,
    "op10_source_mix": source_mix.OP10_SQL,
    "op11_hard_negatives": hard_negatives.OP11_SQL,
    "op12_jaccard_join": jaccard_join.OP12_SQL,
    "op13_lexical_search": lexical_scan.OP13_SQL,
}
