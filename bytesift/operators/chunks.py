"""Long texts cut into overlapping chunks, and the search over chunks.

A chunk is ``(text_id, start, owned, overlap, body)``: ``body`` begins at byte
``start`` of its text, the first ``owned`` bytes belong to the chunk and up to
``overlap`` more follow, so that an occurrence starting in the owned bytes is
whole.  Only the owner reports it, so nothing is counted twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from bytesift.functions import as_bytes, byte_length, cut
from bytesift.operators.search import normal_patterns, normal_texts, positions
from bytesift.plans.choice import choose, overlap_for

DEFAULT_SIZE = 1 << 20


def chunk_texts(
    texts: DataFrame,
    size: int = DEFAULT_SIZE,
    max_pattern_len: int | None = None,
    num_splits: int | None = None,
    num_partitions: int | None = None,
    text_id: str = "text_id",
    body: str = "body",
    patterns: DataFrame | None = None,
    pattern: str = "pattern",
) -> DataFrame:
    """Cut each text to chunks of ``size`` bytes, or to ``num_splits`` equal ones.

    ``max_pattern_len`` is the longest pattern that will be searched; instead of it
    the ``patterns`` can be given, and their longest is measured first.  With
    ``num_partitions`` the chunks are spread over the cluster, whichever text
    they come from; without it they stay in the task that read the text.
    """
    if size < 1 or (num_splits is not None and num_splits < 1):
        raise ValueError("size and num_splits must be at least 1")
    overlap = overlap_for(max_pattern_len, patterns, pattern)
    length = byte_length("_b")
    width = str(size) if num_splits is None else f"CAST(ceil({length} / {num_splits}) AS INT)"
    cuts = (
        normal_texts(texts, {"text_id": text_id}, body)
        .where(f"{length} >= 1")
        .selectExpr("*", f"{width} AS _size")
        .selectExpr("*", f"explode(sequence(0, {length} - 1, _size)) AS _at")
        .selectExpr("*", f"{length} - _at AS _rest")
        .selectExpr("*", "least(_size, _rest) AS owned")
    )
    chunks = cuts.selectExpr(
        "text_id",
        "CAST(_at AS BIGINT) AS start",
        "owned",
        f"{overlap} AS overlap",
        f"{cut('_b', '_at', f'owned + least({overlap}, _rest - owned)')} AS body",
    )
    if num_partitions is None:
        return chunks
    return chunks.repartition(num_partitions, "text_id", "start")


def find_matches_chunked(
    chunks: DataFrame,
    patterns: DataFrame,
    strategy: str = "auto",
    pattern_id: str = "pattern_id",
    pattern: str = "pattern",
) -> DataFrame:
    """(text_id, pattern_id, byte_pos) over chunks, offsets counted in the text.

    Chunks whose overlap is too short for the longest pattern make the job fail
    rather than lose matches.
    """
    bare = normal_patterns(patterns, pattern_id, pattern)
    search = choose(bare, strategy)
    longest = search.stats.max_len
    enough = (
        f"assert_true(overlap >= {longest - 1}, "
        f"'chunk overlap is too short for a pattern of {longest} bytes') IS NULL"
    )
    keys = ["text_id", "start", "owned"]
    bodies = chunks.where(enough).selectExpr(*keys, f"{as_bytes('body')} AS _b")
    found = positions(bodies, keys, bare, search).where("_pos < owned")
    return found.selectExpr("text_id", "_id AS pattern_id", "start + _pos AS byte_pos")
