"""Corpus-wide tables of a fixed size, built in tasks and added up in Spark.

A table (counts, bits or sums) has a size that is set by its parameters and does
not grow with the data, so the driver may hold it and broadcast it.  Tasks emit
it in chunks; chunks are added in two shuffles, streaming, so that no task ever
holds more than one table however many tasks there were.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bytesift.llm.text import mix

CHUNK = 1 << 16
SCHEMA = "chunk INT, blob BINARY"
ARROW = pa.schema([("chunk", pa.int32()), ("blob", pa.binary())])


def emit(table: np.ndarray) -> pa.RecordBatch:
    """The chunks of a flat table that hold anything but zeros."""
    chunks, blobs = [], []
    for at in range(0, len(table), CHUNK):
        part = table[at : at + CHUNK]
        if part.any():
            chunks.append(at // CHUNK)
            blobs.append(zlib.compress(part.tobytes(), 1))
    return pa.RecordBatch.from_arrays([pa.array(chunks, pa.int32()), pa.array(blobs, pa.binary())], schema=ARROW)


def _adder(dtype: str, bits: bool):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, blob in zip(batch["chunk"].to_pylist(), batch["blob"]):
                part = np.frombuffer(zlib.decompress(blob.as_py()), dtype=dtype)
                if chunk not in held:
                    held[chunk] = part.copy()
                elif bits:
                    held[chunk] |= part
                else:
                    held[chunk] += part
        for chunk, part in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())],
                schema=ARROW,
            )

    return add


def gather(chunks: DataFrame, size: int, dtype: str, bits: bool = False) -> np.ndarray:
    """The sum (or the union of bits) of emitted tables of ``size`` cells.

    The first shuffle spreads a chunk over 8 tasks by the task it came from, the
    second adds the 8 sums.  What reaches the driver is one table.
    """
    n = -(-size // CHUNK)
    add = _adder(dtype, bits)
    salted = chunks.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(8)))
    once = salted.repartition(min(64, 8 * n), "chunk", "salt").select("chunk", "blob").mapInArrow(add, SCHEMA)
    twice = once.repartition(min(16, n), "chunk").mapInArrow(add, SCHEMA)
    table = np.zeros(n * CHUNK, dtype=dtype)
    for row in twice.collect():  # one table; an iterator would run a job for each partition
        part = np.frombuffer(zlib.decompress(bytes(row["blob"])), dtype=dtype)
        table[row["chunk"] * CHUNK : row["chunk"] * CHUNK + len(part)] = part
    return table[:size]


# A Bloom filter has this many bits per counted member, a power of two in all, and three
# probes: at most 2 % of other keys pass.  Its bits end at 2^29 (64 MiB, some 50 million
# members); with more members it lets more through, never less.  Users do an exact step
# after it, and ask ``fits`` where they have another way.
BITS_PER_MEMBER = 10
LEAST_LOG2, MOST_LOG2 = 16, 29


def fits(members: int) -> bool:
    return members * BITS_PER_MEMBER <= 1 << MOST_LOG2


def _log2(members: int) -> int:
    return min(MOST_LOG2, max(LEAST_LOG2, (members * BITS_PER_MEMBER - 1).bit_length()))


def _probes(hashes: np.ndarray, log2: int) -> Iterator[np.ndarray]:
    for k in range(3):
        yield mix(hashes + np.uint64(k * 0x51ED270B)) >> np.uint64(64 - log2)


def put(table: np.ndarray, hashes: np.ndarray) -> None:
    """Add keys to a filter."""
    for at in _probes(hashes, len(table).bit_length() + 2):
        np.bitwise_or.at(table, (at >> np.uint64(3)).astype(np.int64), (1 << (at & np.uint64(7))).astype(np.uint8))


def bloom(keys: DataFrame, members: int | None = None) -> np.ndarray:
    """The filter of a DataFrame with one BIGINT column; NULL is left out.

    ``members`` is their number, if it is known; else they are counted first.
    """
    name = keys.columns[0]
    size = 1 << (_log2(keys.count() if members is None else members) - 3)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, any_row = np.zeros(size, dtype=np.uint8), False
        for batch in batches:
            held = batch[name].drop_null().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            put(table, held)
            any_row |= len(held) > 0
        if any_row:
            yield emit(table)

    return gather(keys.mapInArrow(build, SCHEMA), size, "uint8", bits=True)


def may_hold(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """False for what is surely not in the filter."""
    found = np.ones(len(hashes), dtype=bool)
    for at in _probes(hashes, len(table).bit_length() + 2):
        found &= (table[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found
