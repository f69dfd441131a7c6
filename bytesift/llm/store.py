"""Tables that are computed once: written to the shared folder and read back."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from bytesift.plans import fresh_folder

# White space between words, and a word, in Java's and in RE2's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read back.

    Its lineage ends there, so a lost executor costs a read and not a recomputation.
    """
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_table(spark: SparkSession, **columns: pa.Array) -> DataFrame:
    """A few rows that the driver has.

    They go to Spark as Arrow: a list of Python rows would be read by an RDD, for which
    each executor starts a second family of Python workers beside those of the queries.
    """
    return spark.createDataFrame(pa.table(columns))


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
