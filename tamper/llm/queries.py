"""Queries of this subpackage: name -> (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from tamper.llm import (ann, chosenpath, conversations, decontaminate, lines, packing, quality,
                        secrets, sharding, simhash, spelling, sql, substring, toxicity)

QUERIES = {
    "op1_quality_classifier": quality.op1_quality_classifier,
    "op2_simhash_dedup": simhash.op2_simhash_dedup,
    "op3_vector_sharding": sharding.op3_vector_sharding,
    "op4_substring_dedup": substring.op4_substring_dedup,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_curve_packing": packing.op6_curve_packing,
    "op7_decontamination": decontaminate.op7_decontamination,
    "op8_secret_scan": secrets.op8_secret_scan,
    "op9_line_dedup": lines.op9_line_dedup,
    "op10_prefix_forest": ann.op10_prefix_forest,
    "op11_prefix_trie": conversations.op11_prefix_trie,
    "op12_spelling_variants": spelling.op12_spelling_variants,
    "op13_chosen_path": chosenpath.op13_chosen_path,
}

# DuckDB SQL with the same rows, where SQL can express the operator on whole tables.
SQL: dict[str, str] = {
    "op11_prefix_trie": sql.PREFIX_TRIE,
    "op12_spelling_variants": sql.SPELLING,
    "op13_chosen_path": sql.CHOSEN_PATH,
}
