"""Checks and analysis of the pattern table itself."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bytesift.functions import as_bytes, byte_length, quoted
from bytesift.operators.search import normal_patterns, positions
from bytesift.plans.choice import choose


def validate_patterns(
    patterns: DataFrame,
    min_len: int = 1,
    max_len: int | None = None,
    dedupe: bool = False,
    keep_invalid: bool = False,
    pattern_id: str = "pattern_id",
    pattern: str = "pattern",
) -> DataFrame:
    """Drop NULL, empty, too short and too long patterns.

    ``dedupe`` also drops all but one row, of the lowest id, of equal patterns.  With
    ``keep_invalid`` nothing is dropped and a ``reason`` column (NULL for the
    good ones) says what is wrong.
    """
    p, size = quoted(pattern), byte_length(as_bytes(quoted(pattern)))
    too_long = "" if max_len is None else f"WHEN {size} > {max_len} THEN 'too long'"
    checked = patterns.selectExpr(
        "*",
        f"""CASE WHEN {p} IS NULL THEN 'null' WHEN {size} = 0 THEN 'empty'
        WHEN {size} < {min_len} THEN 'too short' {too_long} END AS reason""",
    )
    if dedupe:
        # rows that are wrong anyway are spread, so they are no group of their own
        place = (
            f"row_number() OVER (PARTITION BY CAST({p} AS BINARY), IF(reason IS NULL, 0, xxhash64({quoted(pattern_id)}))"
            f" ORDER BY {quoted(pattern_id)})"
        )
        kept = [quoted(c) for c in patterns.columns]
        checked = checked.selectExpr("*", f"{place} AS _place").selectExpr(
            *kept, "IF(reason IS NULL AND _place > 1, 'duplicate', reason) AS reason"
        )
    if keep_invalid:
        return checked
    return checked.where(F.col("reason").isNull()).drop("reason")


# Bytes of patterns whose profiles are put into one batch of rows, about.
PROFILE_BYTES = 1 << 20


def _profiler(most: int = PROFILE_BYTES):
    """The task that profiles its patterns.

    A nested function: it travels to the executors by value, so they need Arrow
    and numpy but not this package.
    """

    def prefix_ends(p: bytes) -> np.ndarray:
        """For each shift i >= 1, where the common prefix of ``p`` and ``p[i:]`` ends in ``p``.

        Linear: inside the stretch that reaches farthest right, a shift has what the
        same place of the prefix had, and only bytes beyond the stretch are compared.
        """
        n, ends = len(p), [0] * len(p)
        left = right = 0
        for i in range(1, n):
            end = min(right, ends[i - left] + left) if i < right else i
            if end >= right:
                end = max(end, i)
                while end < n and p[end - i] == p[end]:
                    end += 1
                left, right = i, end
            ends[i] = end
        return np.array(ends, dtype=np.int64)

    def borders(p: bytes) -> np.ndarray:
        """The longest border of each prefix: what the smallest shift that reaches over it leaves."""
        at = np.arange(len(p))
        shift = np.searchsorted(np.maximum.accumulate(prefix_ends(p)), at, side="right")
        return np.where(shift <= at, at + 1 - shift, 0).astype(np.int32)

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["pattern_id", "len", "lps"]
        for batch in batches:
            low = 0
            while low < len(batch):
                found, size, high = [], 0, low
                while high < len(batch) and size < most:
                    found.append(borders(batch["_p"][high].as_py()))
                    size += len(found[-1])
                    high += 1
                ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
                lps = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(found), pa.int32()))
                sizes = pa.array([len(f) for f in found], pa.int32())
                yield pa.RecordBatch.from_arrays([batch["_id"].slice(low, high - low), sizes, lps], names)
                low = high

    return profile


def pattern_profile(
    patterns: DataFrame, pattern_id: str = "pattern_id", pattern: str = "pattern"
) -> DataFrame:
    """(pattern_id, len, lps, longest_border, shortest_period, self_overlapping).

    ``lps[j]`` is the length of the longest proper prefix of the first j+1 bytes
    that is also their suffix.  A pattern whose longest border is 0 cannot
    overlap itself.  The work is linear in the bytes, and rows stay in their task.
    """
    bare = normal_patterns(patterns, pattern_id, pattern)
    id_type = bare.schema["_id"].dataType.simpleString()
    profile = bare.mapInArrow(_profiler(), f"pattern_id {id_type}, len INT, lps ARRAY<INT>")
    return profile.withColumn("longest_border", F.element_at("lps", -1)).selectExpr(
        "*", "len - longest_border AS shortest_period", "longest_border > 0 AS self_overlapping"
    )


def nested_patterns(
    patterns: DataFrame, pattern_id: str = "pattern_id", pattern: str = "pattern"
) -> DataFrame:
    """(outer_id, inner_id, byte_pos): patterns that occur inside other patterns.

    The patterns are searched in the pattern table, by the same join as texts.
    """
    bare = normal_patterns(patterns, pattern_id, pattern)
    outer = bare.selectExpr("_id AS outer_id", "_p AS _b")
    found = positions(outer, ["outer_id"], bare, choose(bare, "hash"))
    return found.where("outer_id <> _id").selectExpr(
        "outer_id", "_id AS inner_id", "CAST(_pos AS BIGINT) AS byte_pos"
    )
