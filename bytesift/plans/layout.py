"""Partitioning of the inputs, and folders for stored intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def spread(scan: DataFrame, key: str, min_partitions: int | None = None) -> DataFrame:
    """Give a plain file scan at least as many partitions as there are cores.

    A few big row groups leave most cores idle in the search.  A scan that has
    enough splits, as any large table does, is returned as it is: no shuffle.
    Pass a scan only: counting partitions of a plan with shuffles would run them.
    """
    if scan.isStreaming:
        return scan
    wanted = min_partitions or scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= wanted:
        return scan
    return scan.repartition(wanted, key)


def _on_one_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints: the cluster's ``spark.checkpoint.dir``.

    Only a session on one machine that names no folder gets its own; on a cluster
    a folder of one machine would be invisible to the others, so that is refused.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not _on_one_machine(context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="bytesift-"))
    return context.getCheckpointDir()


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has been written to yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
