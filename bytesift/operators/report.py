"""Totals, reports, comparison of match sets and of strategies."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bytesift.operators.chunks import chunk_texts, find_matches_chunked
from bytesift.operators.search import find_matches_multi
from bytesift.plans.choice import LITERAL_BYTES, LITERAL_PATTERNS, setting
from bytesift.plans.layout import fresh_folder

# Matches that a task puts to lists together, and bytes of text that a list is of.
LISTED_TOGETHER = 1 << 17
LIST_BLOCK = 1 << 13

def pattern_totals(
    matches_or_counts: DataFrame, patterns: DataFrame, pattern_id: str = "pattern_id"
) -> DataFrame:
    """(pattern_id, n_matches, n_texts) for every pattern, zeros included.

    Takes matches or the output of ``count_matches``.  Rows are summed per text
    and pattern first, so a frequent pattern shuffles partial sums only.
    """
    counted = "n_matches" in matches_or_counts.columns
    n = F.sum("n_matches") if counted else F.count("*")
    per_text = matches_or_counts.groupBy("pattern_id", "text_id").agg(n.alias("n"))
    totals = per_text.groupBy("pattern_id").agg(
        F.sum("n").alias("n_matches"), F.count(F.when(F.col("n") > 0, 1)).alias("n_texts")
    )
    zero = F.lit(0).cast("long")
    return (
        patterns.select(F.col(pattern_id).alias("pattern_id"))
        .join(totals, "pattern_id", "left")
        .select(
            "pattern_id",
            F.coalesce("n_matches", zero).alias("n_matches"),
            F.coalesce("n_texts", zero).alias("n_texts"),
        )
    )


def match_report(
    matches: DataFrame,
    patterns: DataFrame,
    limit: int | None = None,
    pattern_id: str = "pattern_id",
) -> DataFrame:
    """The matches in report order, then the total, for every pattern.

    Rows are (pattern_id, kind, text_id, position, n_matches): a "match" row has
    a 1-based byte position, the "total" row of a pattern has its number of
    matches, 0 included.  ``limit`` keeps the first matches of each pattern; the
    totals still count all.  ``matches`` is read twice: write it or persist it
    when it is costly to make.
    """
    listed = matches.select("pattern_id", "text_id", (F.col("byte_pos") + 1).alias("position"))
    if limit is not None:
        # a task passes on at most ``limit`` rows of a pattern, and these are ranked in as
        # many parts as a shuffle has, so a pattern with a third of all matches is spread
        spread = int(matches.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        part = F.pmod(F.xxhash64("text_id", "position"), F.lit(spread))
        listed = _first(_first_in_task(listed, limit).withColumn("_part", part), ["pattern_id", "_part"], limit)
        listed = _first(listed, ["pattern_id"], limit).drop("_part")
    id_type = matches.schema["text_id"].dataType
    lines = listed.select(
        "pattern_id", F.lit("match").alias("kind"), "text_id", "position",
        F.lit(None).cast("long").alias("n_matches"),
    )
    totals = pattern_totals(matches, patterns, pattern_id).select(
        "pattern_id", F.lit("total").alias("kind"), F.lit(None).cast(id_type).alias("text_id"),
        F.lit(None).cast("long").alias("position"), "n_matches",
    )
    return lines.unionByName(totals).orderBy("pattern_id", "kind", "text_id", "position")


def _first_in_task(listed: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` rows of each pattern of each task, before any shuffle."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, had = None, 0  # the pattern of the row before, and how many rows it had
        for batch in batches:
            if not len(batch):
                continue
            column = batch["pattern_id"]
            codes = column.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            new = np.ones(len(codes), dtype=bool)
            new[1:] = np.diff(codes) != 0
            starts = np.flatnonzero(new)
            place = np.arange(len(codes)) - np.repeat(starts, np.diff(np.append(starts, len(codes))))
            if had and column[0].as_py() == last:
                end = starts[1] if len(starts) > 1 else len(codes)
                place[:end] += had
            last, had = column[-1].as_py(), int(place[-1]) + 1
            yield batch.filter(pa.array(place < limit))

    return listed.sortWithinPartitions("pattern_id", "text_id", "position").mapInArrow(keep, listed.schema)


def _first(listed: DataFrame, by: list[str], limit: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy(*by).orderBy("text_id", "position"))
    return listed.withColumn("_rank", rank).where(F.col("_rank") <= limit).drop("_rank")


def diff_matches(a: DataFrame, b: DataFrame) -> DataFrame:
    """(text_id, pattern_id, byte_pos, side): what one run found more often.

    An empty result means that the runs agree.  Both sides are summed in one
    grouping, so each is evaluated once; a surplus of k rows comes out k times.
    """
    names = ["text_id", "pattern_id", "byte_pos"]
    tagged = a.select(*names, F.lit(1).alias("_side")).unionByName(
        b.select(*names, F.lit(-1).alias("_side"))
    )
    surplus = tagged.groupBy(*names).agg(F.sum("_side").alias("_d")).where(F.col("_d") != 0)
    side = F.when(F.col("_d") > 0, "a").otherwise("b").alias("side")
    copies = surplus.select(*names, side, F.explode(F.sequence(F.lit(1).cast("long"), F.abs("_d"))).alias("_k"))
    return copies.drop("_k")


def _can_list(matches: DataFrame) -> bool:
    """The ids are of types whose values Arrow can number."""
    plain = (T.NumericType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    kinds = [matches.schema[c].dataType for c in ("text_id", "pattern_id")]
    return all(isinstance(k, plain) or isinstance(k, T.StringType) and k.collation == "UTF8_BINARY" for k in kinds)


def _listed(matches: DataFrame) -> DataFrame:
    """(text_id, pattern_id, block, listed): the sorted positions of a block of a text, 8 bytes each.

    The rows of a text follow each other where the search left it in its task; where
    they do not, there are several lists of a block.
    """
    def made(table: pa.Table, text: np.ndarray) -> pa.RecordBatch:
        pattern = table["pattern_id"].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        pos = table["byte_pos"].to_numpy()
        block = pos // LIST_BLOCK
        order = np.lexsort((pos, pattern, block, text))
        text, pattern, block, pos = text[order], pattern[order], block[order], pos[order]
        new = (np.diff(text) != 0) | (np.diff(pattern) != 0) | (np.diff(block) != 0)
        begin = np.flatnonzero(np.append(True, new))
        cuts = np.append(begin, len(pos)).astype(np.int32) * np.int32(8)
        lists = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(cuts), pa.py_buffer(pos.astype("<i8"))])
        first = pa.array(order[begin])
        ids = [table[c].combine_chunks().take(first) for c in ("text_id", "pattern_id")]
        return pa.RecordBatch.from_arrays([*ids, pa.array(block[begin]), lists], ["text_id", "pattern_id", "block", "listed"])

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) < LISTED_TOGETHER:
                continue
            table = pa.Table.from_batches(held)
            text = numbers(table)
            other = np.flatnonzero(text != text[-1])
            cut = int(other[-1]) + 1 if len(other) else len(text)  # the last text may go on
            yield made(table.slice(0, cut), text[:cut])
            held = table.slice(cut).to_batches()
        if sum(map(len, held)):
            table = pa.Table.from_batches(held)
            yield made(table, numbers(table))

    def numbers(table: pa.Table) -> np.ndarray:
        return table["text_id"].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)

    rows = matches.select("text_id", "pattern_id", "byte_pos")
    ids = [rows.schema["text_id"], rows.schema["pattern_id"]]
    return rows.mapInArrow(put, T.StructType([*ids, T.StructField("block", T.LongType()), T.StructField("listed", T.BinaryType())]))


def _agree(reference: DataFrame, matches: DataFrame) -> bool:
    """The matches are those of the ``reference``, both given as lists: row by row.

    Equal lists cancel each other out; what the others hold is compared by position.
    """
    names = ["text_id", "pattern_id", "block", "listed"]
    tagged = reference.select(*names, F.lit(1).alias("_side")).unionByName(matches.select(*names, F.lit(-1).alias("_side")))
    left = tagged.groupBy(*names).agg(F.sum("_side").alias("_d")).where("_d <> 0").drop("block")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 256):  # bounds what is unpacked at once
                part = batch.slice(low, 256)
                lists = part["listed"].to_pylist()
                pos = np.frombuffer(b"".join(lists), dtype="<i8")
                row = pa.array(np.repeat(np.arange(len(lists)), [len(x) // 8 for x in lists]))
                columns = [part["text_id"].take(row), part["pattern_id"].take(row), pa.array(pos), part["_d"].take(row)]
                yield pa.RecordBatch.from_arrays(columns, ["text_id", "pattern_id", "byte_pos", "_d"])

    fields = [left.schema["text_id"], left.schema["pattern_id"], T.StructField("byte_pos", T.LongType()), left.schema["_d"]]
    rows = left.mapInArrow(unpack, T.StructType(fields))
    return rows.groupBy("text_id", "pattern_id", "byte_pos").agg(F.sum("_d").alias("_d")).where("_d <> 0").isEmpty()


def _in_passes(found_by: Callable[[DataFrame], DataFrame], patterns: DataFrame, pattern: str) -> DataFrame:
    """The union of what is found for slices of the patterns that fit into a plan as literals.

    A row of the pattern table goes to a slice by its hash; there are as many
    slices as it takes for each to keep within the bounds of one plan.
    """
    spark = patterns.sparkSession
    most, most_bytes = setting(spark, LITERAL_PATTERNS), setting(spark, LITERAL_BYTES)
    size = F.octet_length(F.col(pattern).cast("binary")).cast("long")
    total, total_bytes = patterns.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    n = max(1, -(-total // most), -(-total_bytes // most_bytes))
    while True:
        slice_of = F.pmod(F.xxhash64(*patterns.columns), F.lit(n))
        sizes = patterns.groupBy(slice_of.alias("_slice")).agg(F.count("*").alias("n"), F.sum(size).alias("bytes"))
        over = sizes.agg(F.max("n"), F.max("bytes")).first()
        if n >= max(total, 1) or ((over[0] or 0) <= most and (over[1] or 0) <= most_bytes):
            break  # with a slice for each row, what is still over the bounds is refused by the search
        n = min(2 * n, total)
    passes = [found_by(patterns.where(slice_of == i) if n > 1 else patterns) for i in range(n)]
    return reduce(DataFrame.unionAll, passes)


def compare_strategies(
    texts: DataFrame,
    patterns: DataFrame,
    strategies: Iterable[str] = ("scan", "split", "hash"),
    sizes: Iterable[int | None] = (None,),
    text_id: str = "text_id",
    body: str = "body",
    pattern_id: str = "pattern_id",
    pattern: str = "pattern",
    copies: Iterable[int] = (1,),
) -> DataFrame:
    """(strategy, chunk_size, copies, n_patterns, n_bytes, ms, mb_per_s, mb_per_s_core, n_matches, agrees).

    Each strategy runs on whole texts (size None) or on chunks of the given
    sizes, and on every text ``copies`` times over, end to end into a stored table
    that the checks read: no run is evaluated twice.  ``agrees`` compares the
    matches, row by row, with those of the first run on as many copies; they are
    shuffled as lists of positions, one for a block of a text and a pattern.  The
    strategies that hold patterns as literals take larger tables in several passes.
    ``strategy_slopes`` tells from runs on several sizes what a megabyte costs.
    """
    spark = texts.sparkSession
    cores = spark.sparkContext.defaultParallelism
    one_copy = texts.agg(F.sum(F.octet_length(F.col(body).cast("binary")).cast("long"))).first()[0] or 0
    names = {"pattern_id": pattern_id, "pattern": pattern}
    n_patterns = patterns.count()
    sizes, strategies, results = list(sizes), list(strategies), []
    for times in copies:
        read = texts if times == 1 else texts.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(times))))
        n_bytes, reference = one_copy * times, None
        for size in sizes:
            for strategy in strategies:
                started = time.perf_counter()
                if size is None:
                    def by(some, on=read, how=strategy):
                        return find_matches_multi(on, some, how, text_id, body, **names)
                else:
                    chunks = chunk_texts(read, size, text_id=text_id, body=body, patterns=patterns, pattern=pattern)
                    def by(some, on=chunks, how=strategy):
                        return find_matches_chunked(on, some, how, **names)
                found = _in_passes(by, patterns, pattern) if strategy in ("scan", "split") else by(patterns)
                folder = fresh_folder(spark, "run")
                found.write.parquet(folder)
                ms = (time.perf_counter() - started) * 1000.0
                run = spark.read.schema(found.schema).parquet(folder)
                lists = _listed(run) if _can_list(run) else None
                if reference is None:
                    reference, listed, agrees = run, None, True
                elif lists is None:
                    agrees = diff_matches(reference, run).isEmpty()
                else:
                    if listed is None:  # the first run's lists, for all that are compared with it
                        folder = fresh_folder(spark, "lists")
                        _listed(reference).write.parquet(folder)
                        listed = spark.read.schema(lists.schema).parquet(folder)
                    agrees = _agree(listed, lists)
                speed = n_bytes / 1000.0 / ms
                results.append(
                    (strategy, size, times, n_patterns, n_bytes, ms, speed, speed / cores, run.count(), agrees)
                )
    return spark.createDataFrame(
        results,
        "strategy STRING, chunk_size INT, copies INT, n_patterns BIGINT, n_bytes BIGINT, ms DOUBLE, "
        "mb_per_s DOUBLE, mb_per_s_core DOUBLE, n_matches BIGINT, agrees BOOLEAN",
    )


def strategy_slopes(runs: DataFrame) -> DataFrame:
    """(strategy, chunk_size, n_runs, start_ms, ms_per_mb, n_matches_per_mb) of ``compare_strategies``.

    The line through the runs of each strategy and chunk size on several sizes of
    text: ``start_ms`` is what a run costs before it reads, ``ms_per_mb`` what each
    megabyte adds.  Both are NULL where all runs read as much.
    """
    mb = F.col("n_bytes") / 1e6
    return runs.groupBy("strategy", "chunk_size").agg(
        F.count("*").alias("n_runs"),
        F.regr_intercept("ms", mb).alias("start_ms"),
        F.regr_slope("ms", mb).alias("ms_per_mb"),
        F.regr_slope("n_matches", mb).alias("n_matches_per_mb"),
    )
