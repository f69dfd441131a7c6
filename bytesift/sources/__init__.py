"""Sources of texts and patterns, and the sink for matches."""

from bytesift.sources.patterns import read_patterns
from bytesift.sources.sinks import write_matches
from bytesift.sources.texts import read_text_ranges, read_texts

__all__ = ["read_patterns", "read_text_ranges", "read_texts", "write_matches"]
