"""Packing by optimal length buckets.

The lengths of all documents go into one histogram with a bounded number of
bins.  Dynamic programming over it finds the bucket boundaries for which padding
each document to its bucket's boundary wastes least.  Inside a bucket, batches
are filled up to a budget of padded tokens.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bytesift.llm.spread import parts_for, running_sum
from bytesift.llm.store import WORD, small_table, stored

BUCKETS = 16
TOKEN_BUDGET = 65_536
# Lengths up to this are bins of their own; above it a bin is 1/512 of an octave
# wide, so there are at most 512 more bins per doubling of the longest text.
EXACT = 1024


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def bin_of(length: str) -> Column:
    """The upper end of the bin of a length, which is at least the length."""
    width = f"shiftleft(1L, greatest(0, int(floor(log2(greatest({length}, 1)))) - 9))"
    return F.expr(f"IF({length} <= {EXACT}, {length}, CAST(ceil({length} / {width}) AS BIGINT) * {width})")


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """The ``buckets`` (or fewer) boundaries with the least padding in all.

    ``best[j]`` is the least padded total of the first j bins; closing a bucket
    over bins i..j-1 pads each of their documents to ``lengths[j - 1]``.
    """
    n = len(lengths)
    if n == 0:
        return []
    before = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    best, choices = np.full(n + 1, np.inf), []
    best[0] = 0.0
    for _ in range(min(buckets, n)):
        new, choice = best.copy(), np.full(n + 1, -1)
        for j in range(1, n + 1):
            cost = best[:j] + (before[j] - before[:j]) * float(lengths[j - 1])
            i = int(np.argmin(cost))
            if cost[i] < new[j]:
                new[j], choice[j] = cost[i], i
        best = new
        choices.append(choice)
    out, j = [], n
    for choice in reversed(choices):
        if j == 0:
            break
        if choice[j] >= 0:
            out.append(int(lengths[j - 1]))
            j = int(choice[j])
    return sorted(out)


def pack(
    docs: DataFrame, length: Column, key: Column, buckets: int = BUCKETS, budget: int = TOKEN_BUDGET
) -> tuple[DataFrame, list[int]]:
    """Every row of ``docs`` with its bucket and batch, and the boundaries.

    Added columns: n_tokens, bucket (from 0, shortest first), bucket_tokens (the
    boundary, to which each row of the bucket is padded), batch (from 0 inside
    the bucket), slot (place in the batch), padding.  A batch holds
    max(1, budget // bucket_tokens) rows, so only the last one of a bucket is not
    full and only a row longer than the budget has more than the budget, alone.
    Rows of no tokens share the batches of the first bucket.  Rows are dealt to
    batches by the hash of ``key``, equal ones by length.  NULL lengths count 0.
    A column of ``docs`` with the name of an added one gives way to it.
    """
    spark = docs.sparkSession
    # the columns of ``docs`` travel in one struct, so no name of theirs can clash
    sized = stored(
        docs.select(
            F.struct("*").alias("_row"), F.coalesce(length, F.lit(0)).cast("long").alias("n_tokens"), key.alias("_key")
        ),
        "sized",
    )
    # a boundary is the longest document of its bin, not the bin's end
    bins = sized.groupBy(bin_of("n_tokens").alias("bin")).agg(F.count("*").alias("n"), F.max("n_tokens").alias("longest"))
    histogram = sorted(bins.collect(), key=lambda r: r["bin"])
    edges = boundaries(
        np.array([r["longest"] for r in histogram], dtype=np.int64), np.array([r["n"] for r in histogram], dtype=np.int64), buckets
    )
    table = small_table(spark, bucket=pa.array(range(len(edges)), pa.int32()), bucket_tokens=pa.array(edges, pa.int64()))
    which = " ".join(f"WHEN n_tokens <= {edge} THEN {i}" for i, edge in enumerate(edges))
    bucketed = sized.withColumn("bucket", F.expr(f"CASE {which} END") if edges else F.lit(0))
    ranked = running_sum(
        bucketed, "bucket", [F.col("_key"), F.col("n_tokens")], F.xxhash64("_key"), F.lit(1), "_rank",
        parts_for(sum(r["n"] for r in histogram)),
    )
    capacity = F.expr(f"greatest(1, {budget} div greatest(1, bucket_tokens))")
    out = (
        ranked.join(F.broadcast(table), "bucket")
        .withColumn("_capacity", capacity)
        .withColumn("batch", F.expr("_rank div _capacity"))
        .withColumn("slot", F.expr("_rank % _capacity"))
        .withColumn("padding", F.expr("bucket_tokens - n_tokens"))
    )
    added = ["n_tokens", "bucket", "bucket_tokens", "batch", "slot", "padding"]
    return out.select(*[F.col("_row")[c].alias(c) for c in docs.columns if c not in added], *added), edges
