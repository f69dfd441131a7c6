"""Reading texts: whole files, tables, and byte ranges of very long files."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bytesift.plans.choice import overlap_for
from bytesift.plans.layout import spread

CHUNK_SCHEMA = "text_id BIGINT, start BIGINT, owned INT, overlap INT, body BINARY"


def read_texts(
    spark: SparkSession,
    path: str,
    format: str = "binaryFile",
    text_id: str | None = None,
    body: str | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """Texts as (text_id, body, ...).

    "binaryFile" gives one row per file with its whole content, newlines kept;
    its ``text_id`` is a hash of the path, which stays as ``path``.  Any other
    format names a table source, with its id and body columns in ``text_id`` and
    ``body``; further columns are kept.  A scan with fewer splits than cores (or
    than ``min_partitions``) is repartitioned by the id, larger ones are not.
    """
    scan = spark.read.format(format).load(path)
    if format == "binaryFile":
        files = scan.select(
            F.xxhash64("path").alias("text_id"), F.col("content").alias("body"), "path", "length"
        )
        return files if min_partitions is None else spread(files, "text_id", min_partitions)
    named = scan.withColumnsRenamed({text_id or "text_id": "text_id", body or "body": "body"})
    return spread(named, "text_id", min_partitions)


# Bytes of files that one task reads.
TASK_BYTES = 128 << 20


def _range_reader():
    """The task that reads each row's byte range, on any storage Arrow knows.

    A nested function: it travels to the executors by value, so they need Arrow
    but not this package.
    """

    def read(path: str, start: int, size: int) -> bytes:
        if path.startswith("file:"):
            system, name = fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
        else:
            system, name = fs.FileSystem.from_uri(path)
        with system.open_input_file(name) as file:
            return file.read_at(size, start)

    def read_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw = read(row["path"], row["start"], row["owned"] + row["overlap"])
                yield pa.RecordBatch.from_pydict(
                    {
                        "text_id": pa.array([row["text_id"]], pa.int64()),
                        "start": pa.array([row["start"]], pa.int64()),
                        "owned": pa.array([row["owned"]], pa.int32()),
                        "overlap": pa.array([row["overlap"]], pa.int32()),
                        "body": pa.array([raw], pa.binary()),
                    }
                )

    return read_all


def read_text_ranges(
    spark: SparkSession,
    path: str,
    size: int = 16 << 20,
    max_pattern_len: int | None = None,
    num_partitions: int | None = None,
    patterns: DataFrame | None = None,
    pattern: str = "pattern",
) -> DataFrame:
    """Chunks of files, each read by its own byte range on an executor.

    For files beyond the 2 GiB that one value can hold.  Listing them reads no
    content; the ranges are spread evenly, so one huge file uses every core.
    ``max_pattern_len`` is the longest pattern that will be searched; instead of it
    the ``patterns`` can be given, and their longest is measured first.  The result
    goes to ``find_matches_chunked``.
    """
    if size < 1:
        raise ValueError("size must be at least 1")
    overlap = overlap_for(max_pattern_len, patterns, pattern)
    listed = spark.read.format("binaryFile").load(path).select("path", "length")
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(size).cast("long"))
    ranges = listed.where(F.col("length") >= 1).select(
        F.xxhash64("path").alias("text_id"), "path", "length", F.explode(starts).alias("start")
    )
    ranges = ranges.select(
        "text_id",
        "path",
        "start",
        F.least(F.lit(size), F.col("length") - F.col("start")).cast("int").alias("owned"),
        F.lit(overlap).alias("overlap"),
    )
    if num_partitions is None:  # as many as the listed bytes fill, and one for each core
        listed_bytes = listed.agg(F.sum("length")).first()[0] or 0
        num_partitions = max(spark.sparkContext.defaultParallelism, -(-listed_bytes // TASK_BYTES))
    return ranges.repartition(num_partitions, "path", "start").mapInArrow(_range_reader(), CHUNK_SCHEMA)
