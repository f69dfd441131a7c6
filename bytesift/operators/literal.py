"""Searches for a handful of patterns that the plan holds as literals.

Texts are narrowed in steps (whole text, block of bytes, position), each step a
filter on generated offsets.  Everything stays in the task that reads the text:
no shuffle, no join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bytesift.functions import apart_starts_in, byte_length, count_apart, cut, quoted, starts_in

# Offsets of one text are generated in stretches of this many bytes, so that the
# generated arrays stay small however long the text is.
STRETCH = 1 << 20
# Bytes per block of the scan; longer patterns take blocks of their own length,
# so that a block with its overlap is at most twice the block.
SCAN_BLOCK = 64
# Bytes per block of the split; also bounds the list of starts per row.
SPLIT_BLOCK = 1024


@dataclass(frozen=True)
class Literal:
    pattern_id: object
    pattern: bytes

    @property
    def self_overlapping(self) -> bool:
        p = self.pattern
        return any(p.startswith(p[k:]) for k in range(1, len(p)))


def collect_literals(patterns: DataFrame) -> list[Literal]:
    """The rows of ``patterns(_id, _p)``; call only below the literal bounds."""
    rows = patterns.where(f"{byte_length('_p')} >= 1").select("_id", "_p").collect()
    return [Literal(r["_id"], bytes(r["_p"])) for r in rows]


def _id_of(literals: list[Literal], id_type: str) -> Column:
    """The id of literal number ``_i``."""
    ids = F.array(*[F.lit(x.pattern_id) for x in literals]).cast(f"array<{id_type}>")
    return F.get(ids, F.col("_i")).alias("_id")


def _with_patterns(texts: DataFrame, literals: list[Literal]) -> DataFrame:
    """Each text once per literal that it contains.

    The columns added are ``_i`` (number of the literal), ``_p``, ``_m`` (its
    length) and ``_o`` (it can overlap itself).
    """
    kept = [quoted(c) for c in texts.columns]
    if len(literals) == 1:
        # not exploded, so that the filter is evaluated at the scan
        p = literals[0].pattern
        only = [f"X'{p.hex()}' AS _p", f"{len(p)} AS _m", f"{literals[0].self_overlapping} AS _o"]
        return texts.where(f"contains(_b, X'{p.hex()}')").selectExpr(*kept, "0 AS _i", *only)
    rows = ", ".join(
        f"({i}, X'{x.pattern.hex()}', {len(x.pattern)}, {x.self_overlapping})"
        for i, x in enumerate(literals)
    )
    exploded = texts.selectExpr(*kept, f"inline(array({rows})) AS (_i, _p, _m, _o)")
    return exploded.where("contains(_b, _p)")


def _stretches(paired: DataFrame) -> DataFrame:
    """Add ``_lo`` and ``_hi``: the first and last start of each stretch."""
    last = f"{byte_length('_b')} - _m"
    return paired.selectExpr("*", f"explode(sequence(0, {last}, {STRETCH})) AS _lo").selectExpr(
        "*", f"_lo + least({STRETCH - 1}, {last} - _lo) AS _hi"
    )


def _blocks(paired: DataFrame, size: str) -> DataFrame:
    """Add ``_at``, ``_width`` and ``_slice``, the blocks that contain the pattern.

    A slice is the block and the m-1 bytes after it, so an occurrence belongs to
    the one block in which it starts.  The last block ends with its stretch.
    """
    return (
        _stretches(paired)
        .selectExpr("*", f"explode(sequence(_lo, _hi, {size})) AS _at")
        .selectExpr("*", f"least({size}, _hi - _at + 1) AS _width")
        .selectExpr("*", f"{cut('_b', '_at', '_width + _m - 1')} AS _slice")
        .where("contains(_slice, _p)")
    )


def scan_positions(
    texts: DataFrame, keys: list[str], literals: list[Literal], id_type: str
) -> DataFrame:
    """keys, _id, _m, _pos of every occurrence, by narrowing blocks to positions."""
    blocks = _blocks(_with_patterns(texts, literals), f"greatest({SCAN_BLOCK}, _m)")
    found = blocks.selectExpr("*", "explode(sequence(_at, _at + _width - 1)) AS _pos").where(
        f"{cut('_b', '_pos', '_m')} = _p"
    )
    return found.select(*keys, _id_of(literals, id_type), "_m", "_pos")


def split_positions(
    texts: DataFrame, keys: list[str], literals: list[Literal], id_type: str
) -> DataFrame:
    """The rows of :func:`scan_positions`, from a split in front of each match."""
    blocks = _blocks(_with_patterns(texts, literals), str(SPLIT_BLOCK))
    starts = f"IF(_o, {starts_in('_slice', '_p')}, {apart_starts_in('_slice', '_p')})"
    found = blocks.selectExpr("*", f"explode({starts}) AS _local").selectExpr("*", "_at + _local AS _pos")
    return found.select(*keys, _id_of(literals, id_type), "_m", "_pos")


def literal_counts(
    texts: DataFrame, keys: list[str], literals: list[Literal], id_type: str
) -> DataFrame:
    """keys, _id, _n: counts that add up to the number of occurrences.

    A pattern that cannot overlap itself is counted per stretch without looking
    for positions; for one that can, each position found counts 1.
    """
    size = f"IF(_o, greatest({SCAN_BLOCK}, _m), {STRETCH})"
    counted = (
        _blocks(_with_patterns(texts, literals), size)
        .selectExpr("*", "explode(sequence(_at, IF(_o, _at + _width - 1, _at))) AS _pos")
        .where(f"NOT _o OR {cut('_b', '_pos', '_m')} = _p")
        .selectExpr("*", f"IF(_o, 1L, CAST({count_apart('_slice', '_p')} AS BIGINT)) AS _n")
    )
    return counted.select(*keys, _id_of(literals, id_type), "_n")
