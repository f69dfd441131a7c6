"""The dense form of the matches: one 0/1 value per byte of a text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bytesift.functions import as_bytes, byte_length, quoted


def _dense(starts: str, length: str) -> str:
    """ARRAY<TINYINT> of ``length`` with 1 at each of the ascending ``starts``.

    Built from the gaps, so the cost grows with the length alone.
    """
    previous = f"IF(i = 0, -1, get({starts}, i - 1))"
    filled = f"flatten(transform({starts}, (at, i) -> array_append(array_repeat(0Y, at - {previous} - 1), 1Y)))"
    return f"concat({filled}, array_repeat(0Y, {length} - element_at({starts}, -1) - 1))"


def match_mask(
    texts: DataFrame,
    matches: DataFrame,
    max_len: int = 1 << 20,
    text_id: str = "text_id",
    body: str = "body",
) -> DataFrame:
    """(text_id, pattern_id, mask ARRAY<TINYINT>) for each pair with a match.

    A mask is as long as its text, so this is for short texts: a text longer
    than ``max_len`` bytes that has a match makes the job fail.  Chunk it first.
    """
    lengths = texts.selectExpr(
        f"{quoted(text_id)} AS text_id", f"{byte_length(as_bytes(quoted(body)))} AS _n"
    )
    gathered = (
        matches.join(lengths, "text_id")
        .groupBy("text_id", "pattern_id")
        .agg(F.expr("max(_n) AS _n"), F.expr("array_sort(collect_set(CAST(byte_pos AS INT))) AS _starts"))
    )
    # on the aggregated row: lower down it would be moved to texts without a match
    short = f"assert_true(_n <= {max_len}, 'a text is longer than max_len={max_len} bytes') IS NULL"
    gathered = gathered.where(short)
    return gathered.selectExpr("text_id", "pattern_id", f"{_dense('_starts', '_n')} AS mask")
