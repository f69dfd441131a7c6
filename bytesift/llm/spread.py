"""Running sums per group without one task per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows that one window partition is meant to hold.
ROWS_PER_PART = 4_000


def parts_for(rows: int) -> int:
    """How many parts each group is dealt into: grows with the table."""
    return max(8, -(-rows // ROWS_PER_PART))


def running_sum(
    df: DataFrame, group: str, order: list[Column], deal: Column, value: Column, name: str, parts: int
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of the group before this one.

    The order is by part (``deal`` modulo ``parts``), then by ``order``, so it does
    not depend on how the rows are partitioned.  A window runs inside each
    (group, part); a second one runs over one row per (group, part), so a group
    with any share of the rows is spread over ``parts`` tasks.  NULL is a group.
    ``df`` is read twice: pass a stored table.
    """
    dealt = df.withColumn("_part", F.pmod(deal, F.lit(parts)).cast("int")).withColumn("_value", value)

    def before(*keys: str) -> Window:
        return Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)

    base = (
        dealt.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_of"))
        .agg(F.sum("_value").alias("_sum"))
        .withColumn("_base", F.coalesce(F.sum("_sum").over(before("_group").orderBy("_of")), F.lit(0)))
        .drop("_sum")
    )
    inside = F.coalesce(F.sum("_value").over(before(group, "_part").orderBy(*order)), F.lit(0))
    summed = dealt.withColumn("_inside", inside)
    joined = summed.join(base, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_of")))
    return joined.withColumn(name, F.col("_base") + F.col("_inside")).drop(
        "_part", "_of", "_group", "_value", "_inside", "_base"
    )
