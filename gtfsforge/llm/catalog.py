"""Queries of this subpackage: name -> (Spark callable, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, centroid_clustering, conversation_trie, embedding_near_dedup, html_extraction, packing, quality_classifier, quality_rules, simhash_near_dedup, source_mixing, substring_dedup, token_counts, url_filter

Query = Callable[[SparkSession, str], DataFrame]

#: Where SQL cannot express an operator the SQL is None and tests hold it against brute force.
QUERIES: dict[str, tuple[Query, str | None]] = {
    "op1_embedding_near_dedup": (embedding_near_dedup.op1_embedding_near_dedup, embedding_near_dedup.ORACLE),
    "op2_substring_dedup": (substring_dedup.op2_substring_dedup, substring_dedup.ORACLE),
    "op3_simhash_near_dedup": (simhash_near_dedup.op3_simhash_near_dedup, None),
    "op4_quality_classifier": (quality_classifier.op4_quality_classifier, None),
    "op5_url_filter": (url_filter.op5_url_filter, url_filter.ORACLE),
    "op6_html_extraction": (html_extraction.op6_html_extraction, None),
    "op7_token_counts": (token_counts.op7_token_counts, None),
    "op8_bpe": (bpe.op8_bpe, None),
    "op9_quality_rules": (quality_rules.op9_quality_rules, None),
    "op10_packing": (packing.op10_packing, None),
    "op11_centroid_clustering": (centroid_clustering.op11_centroid_clustering, centroid_clustering.ORACLE),
    "op12_conversation_trie": (conversation_trie.op12_conversation_trie, conversation_trie.ORACLE),
    "op13_source_mixing": (source_mixing.op13_source_mixing, None),
}
