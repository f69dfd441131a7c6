"""Texts that come in ordered pieces: matches that straddle the pieces."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from bytesift.functions import as_bytes, byte_length, cut, quoted
from bytesift.operators.search import normal_patterns, positions
from bytesift.plans import fresh_folder
from bytesift.plans.choice import choose

if TYPE_CHECKING:
    import pandas as pd

# New bytes after which the stateful step emits a row, however many pieces come.
ROW_BYTES = 1 << 22
# Ranges that stored pieces are dealt to at most.
MOST_RANGES = 20_000
# Bytes of text per block when stored pieces are put together.
BLOCK = 1 << 16

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Why a piece is not part of the text.
LATE, GAP = "late or repeated", "no predecessor"


def _stitcher(keep: int, first_order: int | None, timeout_ms: int | None, event_time: bool) -> StatefulProcessor:
    """The stateful step: put new pieces behind the last ``keep`` bytes seen.

    State per key: one value (that tail, the offset of its first byte, the last order
    number, how many pieces wait, when the key ends), and a map of the pieces that wait
    for a predecessor, so that a piece is read from state only when its turn has come.
    The class is made here so that it travels to the executors by value, without this
    package.
    """
    row_bytes, late, gap = ROW_BYTES, LATE, GAP

    import pandas as pd  # here, as each Python worker loads this module

    def text(key: tuple, start: int, seen: int, joined: bytearray) -> pd.DataFrame:
        return pd.DataFrame({"key": [key[0]], "start": [start], "seen": [seen], "_b": [bytes(joined)], "piece": [-1], "reason": [None]})

    def refused(key: tuple, orders: list[int], reason: str) -> pd.DataFrame:
        n = len(orders)
        return pd.DataFrame({"key": [key[0]] * n, "start": [-1] * n, "seen": [0] * n, "_b": [b""] * n, "piece": orders, "reason": [reason] * n})

    class Stitcher(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.seen = handle.getValueState("seen", "tail BINARY, base BIGINT, last BIGINT, held BIGINT, until BIGINT")
            self.early = handle.getMapState("early", "piece BIGINT", "body BINARY")

        def handleInputRows(self, key: tuple, rows: Iterable[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            if self.seen.exists():
                tail, base, last, held, until = self.seen.get()
            else:
                tail, base, last, held, until = b"", 0, None if first_order is None else first_order - 1, 0, None
            new, again, at = {}, [], None
            for frame in rows:
                for order, body in zip(frame["number"], frame["body"]):
                    order = int(order)
                    if order in new or (last is not None and order <= last) or (held and self.early.containsKey((order,))):
                        again.append(order)
                    else:
                        new[order] = bytes(body)
                if event_time:
                    newest = frame["at"].max()
                    at = newest if at is None or newest > at else at
            tail = bytes(tail)
            joined, seen = bytearray(tail), len(tail)
            todo = iter(sorted(new)) if first_order is None else None
            while True:
                if todo is not None:
                    order = next(todo, None)
                    if order is None:
                        break
                    joined += new.pop(order)
                elif (order := last + 1) in new:
                    joined += new.pop(order)
                elif held and self.early.containsKey((order,)):
                    joined += bytes(self.early.getValue((order,))[0])
                    self.early.removeKey((order,))
                    held -= 1
                else:
                    break
                last = order
                if len(joined) - seen >= row_bytes:
                    yield text(key, base, seen, joined)
                    base += max(0, len(joined) - keep)
                    joined = joined[max(0, len(joined) - keep) :]
                    seen = len(joined)
            if len(joined) > seen:
                yield text(key, base, seen, joined)
            for order, body in new.items():
                self.early.updateValue((order,), (body,))
                held += 1
            if again:
                yield refused(key, again, late)
            if timeout_ms is not None:
                now = timerValues.getCurrentProcessingTimeInMs() if not event_time else int(at.timestamp() * 1000)
                ends = max(now + timeout_ms, until or 0)
                if ends != until:
                    if until is not None:
                        self.handle.deleteTimer(until)
                    self.handle.registerTimer(ends)
                    until = ends
            low = max(0, len(joined) - keep)
            self.seen.update((bytes(joined[low:]), base + low, last, held, until))

        def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            waiting = sorted(k[0] for k in self.early.keys())
            self.early.clear()
            self.seen.clear()
            if waiting:
                yield refused(key, waiting, gap)

        def close(self) -> None:
            pass

    return Stitcher()


def _use_rocksdb(spark: SparkSession) -> None:
    """Timers and maps of state need this store; queries take it when they start."""
    if spark.conf.get(STATE_STORE) != ROCKSDB:
        spark.conf.set(STATE_STORE, ROCKSDB)


def _milliseconds(spark: SparkSession, interval: str) -> int:
    lasts = f"unix_millis(timestamp_seconds(0) + INTERVAL {interval}) - unix_millis(timestamp_seconds(0))"
    return spark.range(1).selectExpr(f"{lasts} AS ms").first()["ms"]


def stream_stitch(
    stream: DataFrame,
    key: str,
    order: str,
    keep: int,
    first_order: int | None = None,
    timeout: str | None = None,
    event_time: str | None = None,
    watermark: str | None = None,
    body: str = "body",
) -> DataFrame:
    """The texts of all keys as they grow: (key, start, seen, _b, piece, reason).

    A row has new bytes of a key behind the last ``keep`` ones: ``_b`` starts at offset
    ``start``, and its first ``seen`` bytes were in a row before.  A piece that is late
    or repeated, or that waited for a predecessor until its key ended, is a row with a
    ``reason`` and its order number in ``piece``; no piece makes the query fail.

    A key ends, and leaves the state, when nothing came for it during ``timeout``: with
    ``event_time`` when the ``watermark`` (a delay) has passed its newest piece by that
    much, else by the clock.  What comes for it later is a new text.  A query that goes by
    the clock looks at it for ever, so it does not end by itself, not even with
    ``availableNow``.  Without a timeout keys are kept.  Pieces with a NULL order are left
    out, and with ``event_time`` those older than the watermark.
    """
    spark = stream.sparkSession
    if event_time is not None and watermark is None:
        raise ValueError("event_time needs a watermark")
    _use_rocksdb(spark)
    # plain names: what starts with "_" is renamed on its way to the stateful step
    named = [f"{quoted(key)} AS key", f"CAST({quoted(order)} AS BIGINT) AS number", f"coalesce({as_bytes(quoted(body))}, X'') AS body"]
    if event_time is None:
        pieces = stream.selectExpr(*named)
    else:
        pieces = stream.selectExpr(*named, f"CAST({quoted(event_time)} AS TIMESTAMP) AS at").withWatermark("at", watermark)
    pieces = pieces.where("number IS NOT NULL")
    key_type = pieces.schema["key"].dataType.simpleString()
    timeout_ms = None if timeout is None else _milliseconds(spark, timeout)
    mode = "None" if timeout is None else "ProcessingTime" if event_time is None else "EventTime"
    return pieces.groupBy("key").transformWithStateInPandas(
        _stitcher(keep, first_order, timeout_ms, event_time is not None),
        f"key {key_type}, start BIGINT, seen INT, _b BINARY, piece BIGINT, reason STRING",
        "append",
        mode,
    )


def stream_find_across(
    stream: DataFrame,
    key: str,
    order: str,
    patterns: DataFrame,
    first_order: int | None = None,
    num_partitions: int | None = None,
    timeout: str | None = None,
    event_time: str | None = None,
    watermark: str | None = None,
    body: str = "body",
    pattern_id: str = "pattern_id",
    pattern: str = "pattern",
) -> DataFrame:
    """(key, pattern_id, byte_pos), offsets counted over all pieces of the key.

    The stateful step only joins each key's new pieces to its last m-1 bytes;
    the search runs after it, outside the state, and reports a match when it
    ends in the new bytes.  Pieces may come in any order within a micro-batch.
    Across micro-batches: with ``first_order`` the numbers are consecutive from
    there and an early piece waits for its predecessors; without it numbers may
    have gaps.  A piece that comes too late, or twice, is left out here;
    :func:`write_stream_across` stores those too, and :func:`stream_stitch` says when a
    key ends.  ``num_partitions`` spreads the search of one key's text over that many
    tasks, for streams in which a single key has much of it.
    """
    bare = normal_patterns(patterns, pattern_id, pattern)
    search = choose(bare)
    keep = max(0, search.stats.max_len - 1)
    rows = stream_stitch(stream, key, order, keep, first_order, timeout, event_time, watermark, body)
    stitched = rows.where("reason IS NULL").select("key", "start", "seen", "_b")
    if num_partitions is not None:
        stitched = stitched.repartition(num_partitions, "key", "start")
    found = positions(stitched, ["key", "start", "seen"], bare, search).where("_pos + _m > seen")
    return found.selectExpr("key", "_id AS pattern_id", "start + _pos AS byte_pos")


def write_stream_across(
    stream: DataFrame, key: str, order: str, patterns: DataFrame, path: str, checkpoint: str,
    trigger: dict | None = None, pattern_id: str = "pattern_id", pattern: str = "pattern", **options,
) -> StreamingQuery:
    """Store the matches of :func:`stream_find_across`, and beside them the pieces refused.

    Each micro-batch is searched by the batch operator, which takes pattern tables of any
    size.  ``path/matches/batch=<n>`` has (key, pattern_id, byte_pos) and
    ``path/refused/batch=<n>`` (key, piece, reason); a retried batch overwrites its folders.
    ``options`` go to :func:`stream_stitch`.
    """
    bare = normal_patterns(patterns, pattern_id, pattern)
    keep = max(0, choose(bare).stats.max_len - 1)
    rows = stream_stitch(stream, key, order, keep, **options)

    def store(batch: DataFrame, number: int) -> None:
        batch.persist()  # one reading of the state for both
        refused = batch.where("reason IS NOT NULL").select("key", "piece", "reason")
        refused.write.mode("overwrite").parquet(f"{path}/refused/batch={number}")
        stitched = batch.where("reason IS NULL").select("key", "start", "seen", "_b")
        found = positions(stitched, ["key", "start", "seen"], bare, choose(bare)).where("_pos + _m > seen")
        matches = found.selectExpr("key", "_id AS pattern_id", "start + _pos AS byte_pos")
        matches.write.mode("overwrite").parquet(f"{path}/matches/batch={number}")
        batch.unpersist()

    writer = rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def _in_ranges(pieces: DataFrame) -> DataFrame:
    """(key, _order, _size, _range): the pieces in as many ranges as a range has pieces.

    The ranges are those of Spark's range partitioning by key and order, which samples
    both: a long key is cut into many, however its order numbers are spread.  They are
    written, so that every later reading sees the same ones.
    """
    spark = pieces.sparkSession
    sized = pieces.selectExpr("key", "_order", f"CAST({byte_length('_b')} AS BIGINT) AS _size")
    wanted = min(MOST_RANGES, math.isqrt(sized.count()) + 1)
    ranged = sized.repartitionByRange(wanted, "key", "_order").withColumn("_range", F.spark_partition_id())
    folder = fresh_folder(spark, "ranges")
    ranged.write.parquet(folder)
    return spark.read.schema(ranged.schema).parquet(folder)


def _with_offsets(pieces: DataFrame) -> DataFrame:
    """Add ``_from``, the offset of each piece in the text of its key.

    The running length is taken in two levels, inside ranges of pieces and over
    those ranges, so no task ever sorts all pieces of a long key.
    """
    ranged = _in_ranges(pieces)
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    per_range = ranged.groupBy("key", "_range").agg(F.sum("_size").alias("_size"))
    range_starts = per_range.selectExpr(
        "key",
        "_range",
        f"coalesce(sum(_size) OVER (PARTITION BY key ORDER BY _range {before}), 0L) AS _range_from",
    )
    in_range = "OVER (PARTITION BY key, _range ORDER BY _order"
    # pieces that share a number are in one range
    repeated = "raise_error(concat('piece ', _order, ' of a key is repeated'))"
    inside = ranged.selectExpr(
        "*",
        f"IF(lag(_order) {in_range}) = _order, {repeated}, coalesce(sum(_size) {in_range} {before}), 0L)) AS _inside",
    )
    offsets = inside.join(range_starts, ["key", "_range"]).selectExpr(
        "key", "_order", "_range_from + _inside AS _from", "_range_from + _inside + _size AS _to"
    )
    return pieces.join(offsets, ["key", "_order"]).select("key", "_b", "_from", "_to")


def find_across(
    texts: DataFrame,
    key: str,
    order: str,
    patterns: DataFrame,
    block: int = BLOCK,
    body: str = "body",
    pattern_id: str = "pattern_id",
    pattern: str = "pattern",
) -> DataFrame:
    """The matches of :func:`stream_find_across` over a stored table of pieces.

    ``order`` is a whole number, unique per key; pieces that share one make the
    job fail, as they do on a stream.  The text of a key is never put
    together: every piece adds its bytes to the blocks that it reaches, and each
    block with its overlap, bounded in bytes, is searched by itself.
    """
    bare = normal_patterns(patterns, pattern_id, pattern)
    search = choose(bare)
    overlap = max(0, search.stats.max_len - 1)
    pieces = texts.where(f"{byte_length(as_bytes(quoted(body)))} >= 1").selectExpr(
        f"{quoted(key)} AS key",
        f"CAST({quoted(order)} AS BIGINT) AS _order",
        f"{as_bytes(quoted(body))} AS _b",
    )
    # block k holds the bytes from k*block to (k+1)*block+overlap
    first = f"greatest(0L, _from - {overlap}) DIV {block}"
    parts = (
        _with_offsets(pieces)
        .selectExpr("*", f"explode(sequence({first}, (_to - 1) DIV {block})) AS _block")
        .selectExpr(
            "*",
            f"greatest(_from, _block * {block}) AS _low",
            f"least(_to, (_block + 1) * {block} + {overlap}) AS _high",
        )
        .where("_low < _high")
        .selectExpr(
            "key",
            "_block",
            f"""named_struct('at', _low, 'bytes', {cut(
                '_b', 'CAST(_low - _from AS INT)', 'CAST(_high - _low AS INT)')}) AS _part""",
        )
    )
    blocks = parts.groupBy("key", "_block").agg(
        F.expr("array_sort(collect_list(_part)) AS _parts")
    )
    # joined as hexadecimal text: array_join is linear and takes strings
    joined = blocks.selectExpr(
        "key",
        f"_block * {block} AS start",
        "unhex(array_join(transform(_parts, part -> hex(part.bytes)), '')) AS _b",
    )
    found = positions(joined, ["key", "start"], bare, search).where(f"_pos < {block}")
    return found.selectExpr("key", "_id AS pattern_id", "start + _pos AS byte_pos")
