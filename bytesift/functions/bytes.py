"""Byte-wise SQL expressions.

Matching is defined on bytes, so every operator works on ``BINARY``: slicing is
direct there (``substring`` on a STRING walks the characters), ``octet_length``
is free, and any byte value is allowed.  Where a Spark function exists for
strings only, the Latin-1 view maps each byte to exactly one character.

Arguments and results are SQL text for ``selectExpr`` and ``where``: a search is
a few long expressions, and one parsed string is far cheaper to hand to the JVM
than a tree of Column calls.
"""

from __future__ import annotations


def quoted(name: str) -> str:
    """A column name as an SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def as_bytes(value: str) -> str:
    """The value as BINARY; a STRING gives its UTF-8 bytes."""
    return f"CAST({value} AS BINARY)"


def byte_length(value: str) -> str:
    return f"octet_length({value})"


def cut(body: str, start: str, length: str) -> str:
    """``length`` bytes of ``body`` from the 0-based offset ``start``."""
    return f"substring({body}, ({start}) + 1, {length})"


def latin1(value: str) -> str:
    """One character per byte, for functions that take strings only."""
    return f"decode({as_bytes(value)}, 'ISO-8859-1')"


def literal_regex(text: str) -> str:
    r"""A regular expression that matches ``text`` literally, ``\E`` included."""
    return rf"concat(r'\Q', replace({text}, r'\E', r'\E\\E\Q'), r'\E')"


def overlap_regex(text: str) -> str:
    """A zero-width regular expression in front of every occurrence of ``text``.

    Consuming nothing, it also meets occurrences that overlap the previous one.
    """
    return f"concat('(?=', {literal_regex(text)}, ')')"


def apart_starts_in(body: str, pattern: str) -> str:
    """:func:`starts_in` for a pattern that cannot overlap itself.

    The body is split at each occurrence, which takes the occurrence away.
    """
    pieces = f"split({latin1(body)}, {literal_regex(latin1(pattern))}, -1)"
    none = "CAST(array() AS ARRAY<INT>)"
    return f"""
    aggregate(
      transform({pieces}, piece -> length(piece)),
      named_struct('at', -{byte_length(pattern)}, 'starts', {none}),
      (acc, n) -> named_struct(
        'at', acc.at + {byte_length(pattern)} + n,
        'starts', IF(acc.at >= 0, array_append(acc.starts, acc.at), acc.starts)),
      acc -> acc.starts)"""


def starts_in(body: str, pattern: str) -> str:
    """ARRAY<INT> of the 0-based starts of ``pattern`` in ``body``, ascending.

    The body is split in front of each occurrence, so the starts are the running
    sums of the piece lengths.  Piece 0 starts with a match only when the body
    itself does: the lookahead never leaves an empty first piece.
    """
    pieces = f"split({latin1(body)}, {overlap_regex(latin1(pattern))}, -1)"
    lengths = f"transform({pieces}, piece -> length(piece))"
    none = "CAST(array() AS ARRAY<INT>)"
    return f"""
    aggregate(
      {lengths},
      named_struct('at', 0, 'starts', {none}),
      (acc, n) -> named_struct(
        'at', acc.at + n,
        'starts', IF(acc.at > 0 OR startswith({body}, {pattern}),
                     array_append(acc.starts, acc.at), acc.starts)),
      acc -> acc.starts)"""


def count_apart(body: str, pattern: str) -> str:
    """Number of occurrences in ``body`` of a pattern that cannot overlap itself.

    Counted from the bytes that its removal takes away, in one pass.
    """
    removed = f"replace(CAST({body} AS STRING), CAST({pattern} AS STRING), '')"
    return f"({byte_length(body)} - {byte_length(removed)}) DIV {byte_length(pattern)}"
