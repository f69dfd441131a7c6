"""Reading a pattern file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bytesift.operators.patterns import validate_patterns


# Fixed value: the byte order mark of UTF-8.
MARK = b"\xef\xbb\xbf"
# Bytes of the file whose ranges are summed in one task.
STRETCH_BYTES = 128 << 30


def read_patterns(
    spark: SparkSession,
    path: str,
    max_patterns: int | None = None,
    strip_cr: bool = False,
    keep_invalid: bool = False,
) -> DataFrame:
    """One pattern per line of the file: (pattern_id, pattern BINARY).

    Ids are line numbers from 0, blank lines counted (INT, or BIGINT for a file beyond
    2 GiB).  The file is read by byte ranges, so only a line has to fit into a cell.  The separator is never
    part of a pattern and a final newline ends the last line instead of starting
    another.  ``max_patterns`` takes the first lines only, ``strip_cr`` drops a
    carriage return at the end of a line.  Blank lines make no usable pattern:
    they are dropped, or kept with a ``reason`` when ``keep_invalid`` is set.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    if len(lines.inputFiles()) != 1:
        raise ValueError("a pattern list is one file; read several as a table of patterns")
    listed = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()
    length = listed[0] or 0  # an empty file is not listed
    numbered = _numbered(
        lines.select(
            F.col("value").cast("binary").alias("pattern"),
            F.col("_metadata.file_block_start").alias("_split"),
            F.monotonically_increasing_id().alias("_at"),
        ),
        length,
    )
    if max_patterns is not None:
        numbered = numbered.where(F.col("pattern_id") < max_patterns)
    line = F.col("pattern")
    if strip_cr:
        size = F.octet_length(line)
        line = F.when(F.endswith(line, F.lit(b"\r")), line.substr(F.lit(1), size - 1)).otherwise(line)
    # a file has no more lines than bytes
    id_type = "int" if length < 1 << 31 else "bigint"
    patterns = numbered.select(F.col("pattern_id").cast(id_type).alias("pattern_id"), line.alias("pattern"))
    return validate_patterns(patterns, keep_invalid=keep_invalid)


def _numbered(lines: DataFrame, length: int) -> DataFrame:
    """(pattern_id, pattern): lines(pattern, _split, _at) by their place in the file.

    ``_split`` is where the byte range that a line starts in begins, ``_at`` grows from
    line to line of a range.  Lines are counted per range, and the counts are summed in two
    levels, inside stretches of the file and over those, so a list is never in one cell or
    one task.  The reader takes a byte order mark off the first line; the bytes that are
    missing from ``length`` tell, and it is put back.
    """
    per = lines.groupBy("_split").agg(
        F.min("_at").alias("_first"), F.count("*").alias("_n"), F.sum(F.octet_length("pattern") + F.lit(1)).alias("_bytes")
    )
    read = per.agg(F.sum("_bytes")).first()[0]
    ranges = per.withColumn("_stretch", F.expr(f"_split DIV {STRETCH_BYTES}L"))
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    stretches = ranges.groupBy("_stretch").agg(F.sum("_n").alias("_n")).selectExpr(
        "_stretch AS _of", f"coalesce(sum(_n) OVER (ORDER BY _stretch {before}), 0L) AS _base"
    )
    inside = ranges.selectExpr(
        "*", f"coalesce(sum(_n) OVER (PARTITION BY _stretch ORDER BY _split {before}), 0L) AS _inside"
    )
    bases = inside.join(stretches, F.col("_stretch") == F.col("_of")).selectExpr("_split", "_base + _inside - _first AS _add")
    numbered = lines.join(bases, "_split").selectExpr("_at + _add AS pattern_id", "pattern")
    if read is not None and length - read in (len(MARK), len(MARK) - 1):  # with or without a final newline
        first = F.concat(F.lit(MARK), "pattern")
        numbered = numbered.withColumn("pattern", F.when(F.col("pattern_id") == 0, first).otherwise(F.col("pattern")))
    return numbered
