"""Mixing sources to target weights, by blocks of words.

The words of a source, its documents one after the other, are packed into blocks
of a fixed length.  Each output shard draws how many of its slots each source
gets (multinomial, seeded by the shard).  The k-th slot of a source takes the
block that a pseudorandom permutation of its block indices gives for k, one
permutation per pass over the source, and slots meet blocks by joining on
(source, index).  Nothing depends on partitioning, so a rerun gives the same mix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bytesift.llm.spread import parts_for, running_sum
from bytesift.llm.store import WORD, small_table, stored
from bytesift.llm.text import mix as scramble

WEIGHTS = (5.0, 2.0, 1.0)
TOTAL_SHARE = 1.5
MAX_REPEATS = 2.0
BLOCK_WORDS = 128
# A source too small for this many blocks of full length has shorter blocks.
LEAST_BLOCKS = 64
SHARD_SLOTS = 4096
# Slots that a task computes at once.
AT_ONCE = 1 << 16


@dataclass(frozen=True)
class Share:
    """What the mix wants of one source."""

    source: str | None
    size: int
    target: float
    block: int
    n_blocks: int
    quota: int


def targets(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """``total`` shared by weight; above ``most`` times its size a source is cut
    to that, and the excess is shared again by weight among the others."""
    out, free = [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s > 0]
    left = total
    while free:
        weight = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / weight > most * sizes[i]]
        if not over:
            for i in free:
                out[i] = left * weights[i] / weight
            break
        for i in over:
            out[i] = most * sizes[i]
        left -= sum(out[i] for i in over)
        free = [i for i in free if i not in set(over)]
    return out


def plan(sized: DataFrame, block: int, total: float, most: float) -> list[Share]:
    """One row per source comes to the driver: a mix names its sources."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("size")).collect()
    # Spark compares strings by bytes of UTF-8, which is the order of code points
    rows.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    sizes = [int(r["size"]) for r in rows]
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(rows))]
    shares = []
    for row, size, target in zip(rows, sizes, targets(sizes, weights, total * sum(sizes), most)):
        length = max(1, min(block, size // LEAST_BLOCKS))
        n = -(-size // length)
        shares.append(Share(row["source"], size, target, length, n, min(round(target / length), int(most * n))))
    return shares


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1 per key: a Feistel network that is
    walked until it lands inside, so each index is hit exactly once."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2).astype(np.float64))).astype(np.uint64) + np.uint64(1)) // np.uint64(2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.ones(len(index), dtype=bool)
    while todo.any():
        left, right = out[todo] >> half[todo], out[todo] & mask[todo]
        for turn in range(4):
            turned = scramble(right ^ scramble(key[todo] + np.uint64(turn))) & mask[todo]
            left, right = right, left ^ turned
        out[todo] = (left << half[todo]) | right
        todo &= out >= n.astype(np.uint64)
    return out.astype(np.int64)


def slots(spark, shares: list[Share], seed: int) -> DataFrame:
    """(src, idx, times, shard, slot): which block fills which slot."""
    quota = np.array([s.quota for s in shares], dtype=np.int64)
    total = int(quota.sum())
    n_shards = max(1, -(-total // SHARD_SLOTS))
    odds = quota / total if total else quota.astype(float)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch["id"].to_pylist():
                n = min(SHARD_SLOTS, total - shard * SHARD_SLOTS)
                if n > 0:
                    counts = np.random.default_rng([seed, shard]).multinomial(n, odds)
                    hit = np.flatnonzero(counts)
                    first = np.concatenate([[0], np.cumsum(counts[hit])[:-1]])
                    columns = np.full(len(hit), shard), hit.astype(np.int32), counts[hit], first
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["shard", "src", "n", "first"])

    drawn = stored(
        spark.range(0, n_shards, 1, max(1, min(n_shards, 4096))).mapInArrow(draw, "shard BIGINT, src INT, n BIGINT, first BIGINT"),
        "draws",
    )
    based = running_sum(drawn, "src", [F.col("shard")], F.col("shard"), F.col("n"), "base", parts_for(n_shards))
    got = np.zeros(len(shares), dtype=np.int64)
    for row in drawn.groupBy("src").agg(F.sum("n").alias("n")).collect():
        got[row["src"]] = row["n"]
    # what a source drew beyond its quota goes, in order, to those that drew less
    over, under = np.maximum(got - quota, 0), np.maximum(quota - got, 0)
    over_base, under_end = np.cumsum(over) - over, np.cumsum(under)
    n_blocks = np.array([max(1, s.n_blocks) for s in shares], dtype=np.int64)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = {c: batch[c].to_numpy(zero_copy_only=False) for c in ("src", "n", "first", "base", "shard")}
            group = np.cumsum(every["n"]) // AT_ONCE
            for low, high in zip(*_runs(group)):
                yield fill_some({c: v[low:high] for c, v in every.items()})

    def fill_some(drew: dict[str, np.ndarray]) -> pa.RecordBatch:
        each = drew["n"]
        src = np.repeat(drew["src"], each)
        step = np.arange(len(src)) - np.repeat(np.cumsum(each) - each, each)
        k = np.repeat(drew["base"], each) + step
        moved = k >= quota[src]
        rank = over_base[src[moved]] + k[moved] - quota[src[moved]]
        to = np.searchsorted(under_end, rank, side="right")
        k[moved] = got[to] + rank - (under_end[to] - under[to])
        src[moved] = to
        n = n_blocks[src]
        turn = k // n
        key = scramble(src.astype(np.uint64) * np.uint64(1 << 20) + turn.astype(np.uint64) + np.uint64(seed << 40))
        columns = [src, permuted(k % n, n, key), turn, np.repeat(drew["shard"], each), np.repeat(drew["first"], each) + step]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["src", "idx", "turn", "shard", "slot"])

    return based.mapInArrow(fill, "src INT, idx BIGINT, turn BIGINT, shard BIGINT, slot BIGINT")


def _runs(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal values."""
    low = np.flatnonzero(np.concatenate([[len(group) > 0], group[1:] != group[:-1]]))
    return low, np.append(low[1:], len(group))


def _identity() -> list[Column]:
    return [F.col("doc_id"), F.xxhash64("text").alias("_text_hash")]


@dataclass
class Mix:
    """The parts of a mix; ``pieces`` and ``slots`` meet on (src, idx).

    ``rows`` has one row per document: doc_id, _text_hash, _copy (0, 1, .. among
    equal rows), size, src, start.  ``pieces`` has the words ``low:high`` of a
    document that lie in block ``idx`` of its source.
    """

    shares: list[Share]
    rows: DataFrame
    pieces: DataFrame
    slots: DataFrame


def mix(docs: DataFrame, block: int = BLOCK_WORDS, total: float = TOTAL_SHARE, most: float = MAX_REPEATS, seed: int = 7) -> Mix:
    """Mix ``docs(doc_id, text, source)`` to the weights 5, 2, 1, repeating, over
    the sources in code point order, NULL last.

    Columns of ``docs`` beyond these three are not looked at.  A NULL or empty
    text has size 0 and is never taken; equal rows are documents of their own;
    an empty table gives an empty mix.
    """
    spark = docs.sparkSession
    counted = docs.select(
        *_identity(), "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")
    )
    sized = stored(counted, "sizes")
    shares = plan(sized, block, total, most)
    named = small_table(
        spark,
        _source=pa.array([s.source for s in shares], pa.string()),
        src=pa.array(range(len(shares)), pa.int32()),
        block=pa.array([s.block for s in shares], pa.int32()),
    )
    parts = parts_for(sized.count())
    order = [F.col(c) for c in ("doc_id", "_text_hash")]
    placed = running_sum(
        sized, "source", order, F.xxhash64("doc_id", "_text_hash"), F.col("size"), "start", parts
    )
    # ``start`` orders equal rows, so a row is known by (doc_id, _text_hash, start)
    rows = stored(
        placed.join(F.broadcast(named), F.col("source").eqNullSafe(F.col("_source"))).select(
            "doc_id", "_text_hash", "size", "src", "block", "start"
        ),
        "placed",
    )
    cut = rows.where("size > 0").select(
        "*", F.explode(F.expr("sequence(start div block, (start + size - 1) div block)")).alias("idx")
    )
    pieces = cut.select(
        "doc_id", "_text_hash", "size", "src", "start", "idx",
        F.expr("greatest(start, idx * block) - start").alias("low"),
        F.expr("least(start + size, (idx + 1) * block) - start").alias("high"),
    )
    return Mix(shares, rows, pieces, slots(spark, shares, seed))


def _met(mixed: Mix) -> DataFrame:
    """The pieces with ``times``, how often their block was taken; 0 is left out."""
    times = mixed.slots.groupBy("src", "idx").agg(F.count("*").alias("times"))
    return mixed.pieces.join(times, ["src", "idx"])


def mixed_blocks(mixed: Mix) -> DataFrame:
    """The mix in order: one row per piece of a slot's block: shard, slot, source
    number, block index, pass over the source, document and its words low:high."""
    return mixed.slots.join(mixed.pieces, ["src", "idx"]).select(
        "shard", "slot", "src", "idx", "turn", "doc_id", "_text_hash", "low", "high"
    )


def taken(mixed: Mix) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row per document."""
    spark = mixed.rows.sparkSession
    words = _met(mixed).groupBy("src", "start").agg(F.sum(F.expr("(high - low) * times")).alias("taken"))
    shares = small_table(
        spark,
        src=pa.array(range(len(mixed.shares)), pa.int32()),
        source_size=pa.array([s.size for s in mixed.shares], pa.int64()),
        target=pa.array([s.target for s in mixed.shares], pa.float64()),
    )
    # a row with words is known by its source and start; one without is not taken
    full = mixed.rows.withColumn("_start", F.when(F.col("size") > 0, F.col("start")))
    return (
        full.join(words.withColumnRenamed("start", "_start"), ["src", "_start"], "left")
        .join(F.broadcast(shares), "src")
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    )


def mixed_documents(docs: DataFrame, mixed: Mix) -> DataFrame:
    """The mix as documents: each run of a document's words that was taken, and
    the run again as often as it was taken again, with the columns of ``docs``.

    ``text`` is cut from the document as it stands, white space included, and
    ``n_chars``, where there is one, counts it.  Texts are shuffled once.
    """
    level = _met(mixed).select(
        "doc_id", "_text_hash", "start", "size", "low", "high", F.explode(F.expr("sequence(1, int(times))")).alias("level")
    )
    runs = (
        level.groupBy("doc_id", "_text_hash", "start", "level")
        .agg(F.sort_array(F.collect_list(F.struct("low", "high"))).alias("spans"))
        .select("doc_id", "_text_hash", F.expr(
            """aggregate(spans, CAST(array() AS ARRAY<STRUCT<low: BIGINT, high: BIGINT>>), (a, s) ->
                 IF(size(a) > 0 AND element_at(a, -1).high = s.low,
                    concat(slice(a, 1, size(a) - 1), array(named_struct('low', element_at(a, -1).low, 'high', s.high))),
                    concat(a, array(s))))"""
        ).alias("runs"))
        .groupBy("doc_id", "_text_hash")
        .agg(F.flatten(F.collect_list("runs")).alias("_runs"))
    )
    # the columns of ``docs`` travel in one struct, so no name of theirs can clash
    one = docs.select(F.struct("*").alias("_row"), "doc_id", "text", F.xxhash64("text").alias("_text_hash"))
    one = one.dropDuplicates(["doc_id", "_text_hash"])
    keyed = runs.select(F.col("doc_id").alias("_doc"), F.col("_text_hash").alias("_hash"), "_runs")
    joined = one.join(keyed, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_text_hash") == F.col("_hash")))
    words = F.regexp_extract_all("text", F.lit(r"(?:^[\x20\x09-\x0D]+)?" + WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    cut = joined.withColumn("_words", words).withColumn("_run", F.explode("_runs"))
    text = F.expr("array_join(slice(_words, int(_run.low) + 1, int(_run.high - _run.low)), '')")
    made = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.char_length("_text").cast(docs.schema["n_chars"].dataType)
    out = cut.withColumn("_text", text)
    return out.select(*[made.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])
