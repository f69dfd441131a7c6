"""Decisions taken before a search is planned: sizes, strategies, layouts."""

from bytesift.plans.choice import Search, choose, pattern_stats, PatternStats
from bytesift.plans.layout import fresh_folder, shared_folder, spread
from bytesift.plans.windows import WindowClass, window_classes

__all__ = [
    "PatternStats",
    "Search",
    "WindowClass",
    "choose",
    "fresh_folder",
    "pattern_stats",
    "shared_folder",
    "spread",
    "window_classes",
]
