"""Structured Streaming forms, and the batch twin for ordered pieces."""

from bytesift.streaming.across import find_across, stream_find_across, stream_stitch, write_stream_across
from bytesift.streaming.find import (
    stream_find_matches,
    stream_pattern_totals,
    write_stream_matches,
)

__all__ = [
    "find_across",
    "stream_find_across",
    "stream_find_matches",
    "stream_pattern_totals",
    "stream_stitch",
    "write_stream_across",
    "write_stream_matches",
]
