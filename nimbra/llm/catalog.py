"""Registered queries of this package: one for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from nimbra.llm import (
    op1_toxicity,
    op2_simhash,
    op3_bpe,
    op4_token_files,
    op5_language_model,
    op6_quality_rules,
    op7_html_extraction,
    op8_quality_classifier,
    op9_neighbours,
    op10_packing,
    op11_merkle,
    op12_exact_dedup,
    op13_prefix_trie,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity.query,
    "op2_simhash_near_dedup": op2_simhash.query,
    "op3_byte_bpe": op3_bpe.query,
    "op4_token_files": op4_token_files.query,
    "op5_language_model": op5_language_model.query,
    "op6_quality_rules": op6_quality_rules.query,
    "op7_html_extraction": op7_html_extraction.query,
    "op8_quality_classifier": op8_quality_classifier.query,
    "op9_nearest_neighbours": op9_neighbours.query,
    "op10_packing": op10_packing.query,
    "op11_merkle": op11_merkle.query,
    "op12_exact_dedup": op12_exact_dedup.query,
    "op13_prefix_trie": op13_prefix_trie.query,
}
#: DuckDB SQL of those that SQL can express; the others are tested against brute force.
ORACLES: dict[str, str] = {
    "op6_quality_rules": op6_quality_rules.ORACLE,
    "op9_nearest_neighbours": op9_neighbours.ORACLE,
    "op11_merkle": op11_merkle.ORACLE,
    "op12_exact_dedup": op12_exact_dedup.ORACLE,
    "op13_prefix_trie": op13_prefix_trie.ORACLE,
}
