"""Searches on arriving texts.

A search of whole texts needs no state: it is the batch search, with its joins
against the static pattern table, on a streaming DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from bytesift.operators.search import (
    find_matches_multi,
    normal_patterns,
    normal_texts,
    positions,
)
from bytesift.plans.choice import choose


# Patterns that one row of a closed window meets together.
PATTERNS_TOGETHER = 1 << 16


def stream_find_matches(
    stream: DataFrame,
    patterns: DataFrame,
    strategy: str = "auto",
    text_id: str = "text_id",
    body: str = "body",
    pattern_id: str = "pattern_id",
    pattern: str = "pattern",
) -> DataFrame:
    """(text_id, pattern_id, byte_pos) of arriving texts, for append mode."""
    return find_matches_multi(stream, patterns, strategy, text_id, body, pattern_id, pattern)


def write_stream_matches(
    stream: DataFrame, patterns: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
    **names: str,
) -> StreamingQuery:
    """Search each micro-batch with the batch operator and store its matches.

    This takes pattern tables of any size, as a micro-batch can be shuffled.
    Each batch has its own folder ``batch=<n>``, overwritten when it is retried.
    """

    def store(batch: DataFrame, number: int) -> None:
        found = find_matches_multi(batch, patterns, **names)
        found.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def _every_pattern(counted: DataFrame, bare: DataFrame, parts: int) -> DataFrame:
    """(w, pattern_id, n_matches) of all patterns for each closed window.

    ``counted`` has a row without a pattern for each window.  The pattern table is dealt
    to ``parts`` and met by as many copies of the window's row, so it is never broadcast
    because of its size.
    """
    found = F.expr("IF(pattern_id IS NULL, NULL, struct(pattern_id, n_matches))")
    closed = counted.groupBy("w").agg(F.map_from_entries(F.collect_list(found)).alias("found"))
    dealt = closed.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    every = bare.select(F.col("_id").alias("pattern_id")).distinct()
    every = every.withColumn("part", F.pmod(F.xxhash64("pattern_id"), F.lit(parts)).cast("int"))
    joined = dealt.join(every, "part")
    return joined.select("w", "pattern_id", F.coalesce(F.expr("try_element_at(found, pattern_id)"), F.lit(0)).alias("n_matches"))


def stream_pattern_totals(
    stream: DataFrame,
    patterns: DataFrame,
    event_time: str | None = None,
    window: str | None = None,
    slide: str | None = None,
    watermark: str | None = None,
    zeros: bool = False,
    body: str = "body",
    pattern_id: str = "pattern_id",
    pattern: str = "pattern",
) -> DataFrame:
    """Running totals per pattern: (pattern_id, n_matches).

    With ``event_time`` and ``window`` (and ``slide`` for overlapping windows)
    the totals are per event-time window: (window_start, window_end, pattern_id,
    n_matches).  With ``watermark`` late texts are dropped after that delay and
    append mode becomes possible.

    With ``zeros`` (append mode, so with a watermark) each window that had a text has a row
    for every pattern when it closes, 0 for those not found in it.  The patterns found in
    one window are together in one row on the way.
    """
    if zeros and watermark is None:
        raise ValueError("zeros are known when a window closes: they need a watermark")
    if (window is None) != (event_time is None):
        raise ValueError("event_time and window go together")
    bare = normal_patterns(patterns, pattern_id, pattern)
    search = choose(bare)
    if window is None:
        texts = normal_texts(stream, {}, body)
        found = positions(texts, [], bare, search)
        return found.groupBy(F.col("_id").alias("pattern_id")).agg(F.count("*").alias("n_matches"))
    timed = stream
    if watermark is not None:
        if isinstance(stream.schema[event_time].dataType, T.TimestampNTZType):
            # a watermark needs an instant; the session time zone gives it
            timed = timed.withColumn(event_time, F.col(event_time).cast("timestamp"))
        timed = timed.withWatermark(event_time, watermark)
    # the time column keeps its name: its watermark is bound to it
    texts = normal_texts(timed, {event_time: event_time}, body)
    found = positions(texts, [event_time], bare, search).select(event_time, "_id")
    if zeros:  # a text is a row without a pattern, so a window is known without any match
        found = found.unionByName(texts.select(event_time, F.lit(None).cast(found.schema["_id"].dataType).alias("_id")))
    per = F.window(event_time, window, slide) if slide else F.window(event_time, window)
    counted = found.groupBy(per.alias("w"), F.col("_id").alias("pattern_id")).agg(
        F.count("*").alias("n_matches")
    )
    if zeros:
        counted = _every_pattern(counted, bare, max(1, search.stats.count // PATTERNS_TOGETHER))
    return counted.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "pattern_id",
        "n_matches",
    )
