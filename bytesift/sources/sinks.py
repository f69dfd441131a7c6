"""Writing matches and totals."""

from __future__ import annotations

from pyspark.sql import DataFrame

from bytesift.operators.report import pattern_totals


def write_matches(
    matches: DataFrame,
    path: str,
    partition_by: str | list[str] | None = None,
    mode: str = "errorifexists",
    patterns: DataFrame | None = None,
) -> DataFrame:
    """Store matches (or counts) as Parquet and return the stored table.

    With ``partition_by`` the rows are rebalanced by those columns before the
    write: small directories get one file, and a pattern with a third of all
    rows is split over many tasks.  When ``patterns`` is given the matches go to
    ``path/matches`` and their totals, made from the stored rows, to
    ``path/totals``.
    """
    target = path if patterns is None else f"{path}/matches"
    columns = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    balanced = matches.hint("rebalance", *columns) if columns else matches
    writer = balanced.write.mode(mode)
    (writer.partitionBy(*columns) if columns else writer).parquet(target)
    stored = matches.sparkSession.read.schema(matches.schema).parquet(target).select(*matches.columns)
    if patterns is not None:
        pattern_totals(stored, patterns).write.mode(mode).parquet(f"{path}/totals")
    return stored
