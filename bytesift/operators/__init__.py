"""Batch operators."""

from bytesift.operators.chunks import chunk_texts, find_matches_chunked
from bytesift.operators.mask import match_mask
from bytesift.operators.patterns import nested_patterns, pattern_profile, validate_patterns
from bytesift.operators.report import (
    compare_strategies,
    diff_matches,
    match_report,
    pattern_totals,
    strategy_slopes,
)
from bytesift.operators.search import (
    contains_filter,
    count_matches,
    find_matches,
    find_matches_multi,
    hash_join_matches,
)

__all__ = [
    "chunk_texts",
    "compare_strategies",
    "contains_filter",
    "count_matches",
    "diff_matches",
    "find_matches",
    "find_matches_chunked",
    "find_matches_multi",
    "hash_join_matches",
    "match_mask",
    "match_report",
    "nested_patterns",
    "pattern_profile",
    "pattern_totals",
    "strategy_slopes",
    "validate_patterns",
]
