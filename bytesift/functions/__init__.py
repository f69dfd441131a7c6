"""SQL expressions shared by the operators."""

from bytesift.functions.bytes import (
    apart_starts_in,
    as_bytes,
    byte_length,
    count_apart,
    cut,
    latin1,
    literal_regex,
    overlap_regex,
    quoted,
    starts_in,
)

__all__ = [
    "apart_starts_in",
    "as_bytes",
    "byte_length",
    "count_apart",
    "cut",
    "latin1",
    "literal_regex",
    "overlap_regex",
    "quoted",
    "starts_in",
]
