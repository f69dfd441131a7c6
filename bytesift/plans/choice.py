"""How a set of patterns is searched, decided from the measured pattern table.

One small aggregation over the pattern table gives the numbers; nothing is
broadcast or turned into literals unless they stay below a bound.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bytesift.functions import byte_length
from bytesift.plans.windows import WindowClass, window_classes

STRATEGIES = ("scan", "hash", "split")

# Up to this many patterns, with this many bytes in all, are put into the plan
# as literals; the names are session settings, the values their defaults.
LITERAL_PATTERNS = ("spark.bytesift.literalPatterns", 64)
LITERAL_BYTES = ("spark.bytesift.literalBytes", 1 << 16)
# Estimated size up to which the anchors and patterns are broadcast.
BROADCAST_BYTES = ("spark.bytesift.broadcastBytes", 256 << 20)
# Size up to which a bitmap of the anchors' hashes is broadcast when they are shuffled.
FILTER_BYTES = ("spark.bytesift.filterBytes", 256 << 20)
# Salts for the joins of the shuffled path.
SALTS = ("spark.bytesift.salts", 8)

# A sampled window costs about as much as scanning one byte for this many patterns.
WINDOW_COST = 100

# So many short patterns are found by the windows of the shortest of them.
FEW_SHORT = 8

# Rough memory of one row of a broadcast hash table, payload included.
_ROW_BYTES = 64


def setting(spark: SparkSession, named: tuple[str, int]) -> int:
    return int(spark.conf.get(named[0], str(named[1])))


@dataclass(frozen=True)
class PatternStats:
    """Sizes of a pattern table, in all and per window class."""

    count: int
    total_bytes: int
    max_len: int
    per_class: dict[WindowClass, tuple[int, int]] = field(default_factory=dict)
    id_bytes: int = 0


@dataclass(frozen=True)
class Search:
    """The chosen strategy; what follows it matters to "hash" only.

    ``broadcast`` is for the patterns, ``broadcast_shapes`` for the few bytes per
    anchor that find them; the patterns are never broadcast without those.
    """

    strategy: str
    classes: list[WindowClass]
    broadcast: bool
    stats: PatternStats
    broadcast_shapes: bool = True


def class_of(length: str, classes: list[WindowClass]) -> str:
    """STRUCT(q, s) of the class with the longest window that fits ``length``."""
    fits = " ".join(
        f"WHEN {length} >= {c.min_len} THEN named_struct('q', {c.q}, 's', {c.stride})"
        for c in classes
    )
    return f"CASE {fits} END"


def pattern_stats(patterns: DataFrame, classes: list[WindowClass]) -> PatternStats:
    """Measure ``patterns(_id, _p BINARY)``: one job, one row back per window class."""
    named = f"coalesce({byte_length('CAST(_id AS STRING)')}, 0)" if "_id" in patterns.columns else "0"
    sized = patterns.selectExpr(f"{byte_length('_p')} AS m", f"{named} AS id_size").where("m >= 1")
    rows = (
        sized.groupBy(F.expr(class_of("m", classes)).alias("c"))
        .agg(F.expr("count(*) AS n"), F.expr("sum(CAST(m AS BIGINT)) AS bytes"), F.expr("max(m) AS longest"), F.expr("sum(id_size) AS ids"))
        .collect()
    )
    return PatternStats(
        count=sum(r["n"] for r in rows),
        total_bytes=sum(r["bytes"] for r in rows),
        max_len=max((r["longest"] for r in rows), default=0),
        per_class={WindowClass(r["c"]["q"], r["c"]["s"]): (r["n"], r["bytes"]) for r in rows},
        id_bytes=sum(r["ids"] for r in rows),
    )


def overlap_for(max_pattern_len: int | None, patterns: DataFrame | None, pattern: str = "pattern") -> int:
    """Bytes that a chunk needs beyond its own: one less than the longest pattern.

    The length is given, or measured: one small aggregation over the pattern table.
    """
    if (max_pattern_len is None) == (patterns is None):
        raise ValueError("give either max_pattern_len or the patterns to measure")
    if patterns is not None:
        longest = F.max(F.octet_length(F.col(pattern).cast("binary")))
        max_pattern_len = max(patterns.agg(longest).first()[0] or 1, 1)
    if max_pattern_len < 1:
        raise ValueError("max_pattern_len must be at least 1")
    return max_pattern_len - 1


def shape_bytes(stats: PatternStats, most_stride: int) -> int:
    """Upper estimate of the anchor shapes: one for each residue of each pattern."""
    return sum(n * min(c.stride, most_stride) * _ROW_BYTES for c, (n, _) in stats.per_class.items())


def anchor_bytes(stats: PatternStats, most_stride: int) -> int:
    """Upper estimate of what "hash" broadcasts with strides up to ``most_stride``.

    A pattern is key and payload of its row, which also has its id and its list
    of residues.
    """
    rows = sum(n * (_ROW_BYTES + 4 * min(c.stride, most_stride)) for c, (n, _) in stats.per_class.items())
    return shape_bytes(stats, most_stride) + rows + 2 * stats.total_bytes + stats.id_bytes


def _present(classes: list[WindowClass], stats: PatternStats) -> list[WindowClass]:
    """The classes that patterns are in, but a few patterns of an every-byte class go to the next one.

    Two classes that take a window at every byte make all windows twice; a few patterns
    found by shorter windows make fewer rows than that.
    """
    present = [c for c in classes if c in stats.per_class]
    every_byte = [c for c in present if c.stride == 1 and c.q > 1]
    for c, after in zip(every_byte, every_byte[1:]):
        if sum(stats.per_class[x][0] for x in every_byte) <= FEW_SHORT:
            present.remove(c)
    return present


def choose(
    patterns: DataFrame,
    strategy: str = "auto",
    q: int = 32,
    stride: int = 32,
) -> Search:
    """Measure ``patterns(_p)`` and pick the strategy, classes and join kind.

    "auto" compares the cost per byte of text: a scan pays for each pattern, the
    hash join for each sampled window, so a handful of patterns is scanned for
    and anything more is hash-joined.  For "hash", long strides make few text
    windows but many anchors; when these outgrow the broadcast bound the stride is
    halved until they fit.  The window keeps its length, so it stays selective.
    When not even stride 1 lets the patterns in, only the shapes of the anchors
    are broadcast, and when those do not fit either both joins are shuffled.
    """
    if strategy != "auto" and strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}, expected auto or one of {STRATEGIES}")
    spark = patterns.sparkSession
    classes = window_classes(q, stride)
    stats = pattern_stats(patterns, classes)
    few = stats.count <= setting(spark, LITERAL_PATTERNS)
    small = stats.total_bytes <= setting(spark, LITERAL_BYTES)
    if strategy == "auto":
        windows_per_byte = sum(1 / c.stride for c in stats.per_class)
        cheaper = stats.count <= WINDOW_COST * windows_per_byte
        strategy = "scan" if few and small and cheaper else "hash"
    elif strategy != "hash" and not (few and small):
        raise ValueError(
            f"strategy {strategy!r} holds the patterns as literals and takes at most "
            f"{setting(spark, LITERAL_PATTERNS)} of them with {setting(spark, LITERAL_BYTES)} bytes; "
            f"use 'hash' (or 'auto')"
        )
    limit = setting(spark, BROADCAST_BYTES)
    strides = [stride]
    while strides[-1] > 1:
        strides.append(strides[-1] // 2)
    present = _present(classes, stats)
    for whole, size_of in ((True, anchor_bytes), (False, shape_bytes)):
        for most in strides:
            if size_of(stats, most) <= limit:
                return Search(strategy, [c.with_stride_up_to(most) for c in present], whole, stats)
    return Search(strategy, present, False, stats, broadcast_shapes=False)
