"""Filters and searches over tables of texts and patterns.

``texts`` has an id column and a body (STRING or BINARY), ``patterns`` an id and
a pattern (STRING or BINARY); the names are parameters.  A match is
``(text_id, pattern_id, byte_pos)``, ``byte_pos`` being the 0-based byte offset
of its start.  Overlapping occurrences all count, comparison is byte for byte,
and NULL or empty values match nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bytesift.functions import as_bytes, byte_length, quoted
from bytesift.operators.literal import (
    Literal,
    collect_literals,
    literal_counts,
    scan_positions,
    split_positions,
)
from bytesift.operators.windowed import hash_positions
from bytesift.plans.choice import STRATEGIES, Search, choose


def _literal(pattern: str | bytes) -> bytes:
    raw = pattern.encode("utf-8") if isinstance(pattern, str) else bytes(pattern)
    if not raw:
        raise ValueError("the pattern is empty")
    return raw


def _contains(texts: DataFrame, body: str, raw: bytes) -> Column:
    """``body`` contains ``raw``; on a STRING column in a form a scan can take."""
    kind = texts.schema[body].dataType
    if isinstance(kind, T.StringType) and kind.collation == "UTF8_BINARY":
        try:
            return F.contains(F.col(body), F.lit(raw.decode("utf-8")))
        except UnicodeDecodeError:
            pass
    return F.contains(F.col(body).cast("binary"), F.lit(raw))


def normal_texts(texts: DataFrame, keys: dict[str, str], body: str) -> DataFrame:
    """The key columns under their new names, and the body as ``_b BINARY``."""
    renamed = [f"{quoted(old)} AS {quoted(new)}" for new, old in keys.items()]
    bodies = texts.selectExpr(*renamed, f"{quoted(body)} AS _b").where("_b IS NOT NULL")
    return bodies.selectExpr(*map(quoted, keys), f"{as_bytes('_b')} AS _b")


def normal_patterns(patterns: DataFrame, pattern_id: str, pattern: str) -> DataFrame:
    """``_id`` and ``_p BINARY``, without NULL and empty patterns."""
    bare = patterns.selectExpr(f"{quoted(pattern_id)} AS _id", f"{as_bytes(quoted(pattern))} AS _p")
    return bare.where(f"{byte_length('_p')} >= 1")


def positions(texts: DataFrame, keys: list[str], patterns: DataFrame, search: Search) -> DataFrame:
    """keys, _id, _m, _pos for normal texts and patterns by the chosen strategy."""
    if search.strategy == "hash" or search.stats.count == 0:
        return hash_positions(texts, keys, patterns, search)
    id_type = patterns.schema["_id"].dataType.simpleString()
    by = scan_positions if search.strategy == "scan" else split_positions
    return by(texts, keys, collect_literals(patterns), id_type)


def _matches(found: DataFrame) -> DataFrame:
    return found.selectExpr("text_id", "_id AS pattern_id", "CAST(_pos AS BIGINT) AS byte_pos")


def contains_filter(
    texts: DataFrame, pattern: str | bytes, negate: bool = False, body: str = "body"
) -> DataFrame:
    """The texts with at least one occurrence of ``pattern``, or those without.

    A NULL text has no occurrence, so the negated filter keeps it.
    """
    found = _contains(texts, body, _literal(pattern))
    return texts.where(F.col(body).isNull() | ~found) if negate else texts.where(found)


def find_matches(
    texts: DataFrame,
    pattern: str | bytes,
    strategy: str = "auto",
    pattern_id: int = 0,
    text_id: str = "text_id",
    body: str = "body",
) -> DataFrame:
    """Every occurrence of one pattern: (text_id, pattern_id, byte_pos)."""
    raw = _literal(pattern)
    if strategy == "hash":
        spark = texts.sparkSession
        one = spark.createDataFrame([(pattern_id, raw)], "pattern_id INT, pattern BINARY")
        return find_matches_multi(texts, one, "hash", text_id=text_id, body=body)
    if strategy not in ("auto", *STRATEGIES):
        raise ValueError(f"unknown strategy {strategy!r}, expected auto or one of {STRATEGIES}")
    by = split_positions if strategy == "split" else scan_positions
    holding = normal_texts(texts.where(_contains(texts, body, raw)), {"text_id": text_id}, body)
    return _matches(by(holding, ["text_id"], [Literal(pattern_id, raw)], "int"))


def find_matches_multi(
    texts: DataFrame,
    patterns: DataFrame,
    strategy: str = "auto",
    text_id: str = "text_id",
    body: str = "body",
    pattern_id: str = "pattern_id",
    pattern: str = "pattern",
) -> DataFrame:
    """Every occurrence of every pattern in every text.

    ``strategy`` is "scan", "split" (a handful of patterns, held as literals),
    "hash" (any number), or "auto".  The result is the same for all of them.
    """
    bare = normal_patterns(patterns, pattern_id, pattern)
    search = choose(bare, strategy)
    return _matches(
        positions(normal_texts(texts, {"text_id": text_id}, body), ["text_id"], bare, search)
    )


def hash_join_matches(
    texts: DataFrame,
    patterns: DataFrame,
    q: int = 32,
    stride: int = 32,
    text_id: str = "text_id",
    body: str = "body",
    pattern_id: str = "pattern_id",
    pattern: str = "pattern",
) -> DataFrame:
    """Every occurrence, by equi-joining hashed text windows to hashed anchors.

    Windows of ``q`` bytes at multiples of ``stride`` serve the patterns of at
    least ``q + stride - 1`` bytes; shorter ones take halved windows.
    """
    bare = normal_patterns(patterns, pattern_id, pattern)
    search = choose(bare, "hash", q, stride)
    return _matches(
        hash_positions(normal_texts(texts, {"text_id": text_id}, body), ["text_id"], bare, search)
    )


def count_matches(
    texts: DataFrame,
    patterns: DataFrame,
    strategy: str = "auto",
    text_id: str = "text_id",
    body: str = "body",
    pattern_id: str = "pattern_id",
    pattern: str = "pattern",
) -> DataFrame:
    """(text_id, pattern_id, n_matches) for every pair that has a match.

    Of a handful of patterns, those that cannot overlap themselves are counted
    inside the row without looking for positions; the others, and larger sets,
    are found and counted.  Partial sums are made before the shuffle in any case.
    """
    bare = normal_patterns(patterns, pattern_id, pattern)
    search = choose(bare, strategy)
    bodies = normal_texts(texts, {"text_id": text_id}, body)
    if search.strategy == "hash" or search.stats.count == 0:
        found = hash_positions(bodies, ["text_id"], bare, search)
        counted = found.selectExpr("text_id", "_id", "1L AS _n")
    elif search.strategy == "split":
        found = positions(bodies, ["text_id"], bare, search)
        counted = found.selectExpr("text_id", "_id", "1L AS _n")
    else:
        id_type = bare.schema["_id"].dataType.simpleString()
        counted = literal_counts(bodies, ["text_id"], collect_literals(bare), id_type)
    return counted.groupBy("text_id", F.col("_id").alias("pattern_id")).agg(
        F.sum("_n").alias("n_matches")
    )
