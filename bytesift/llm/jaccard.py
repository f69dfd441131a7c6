"""Jaccard join on word shingles: rare-first prefixes, filters, one check per pair.

Two sets with 100 |A n B| >= 80 |A u B| share at least ceil(0.8 |A|) elements of
A, so, with any one order of all shingles, they share one among the first
|A| - ceil(0.8 |A|) + 1 of A and as many of B.  Rare shingles come first in that
order.  How rare a shingle is comes from counts over the whole corpus in a table
of a fixed size: its cells may be shared, which makes the order less good but
never a different one for two documents, so no pair is lost by it.

Documents with equal sets are one class from the start; only its smallest doc_id
takes part.  Shingles are 64-bit hashes; classes are told apart by 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bytesift.llm import blobs
from bytesift.llm.links import linked_components
from bytesift.llm.store import stored
from bytesift.llm.text import scan, shingle_sets, some_rows

SHINGLE_WORDS = 5
THRESHOLD = 80  # of 100

# Cells of the table of counts.
CELLS_LOG2 = 20
# Postings of a shingle that one task is meant to see together.
POSTINGS_TOGETHER = 4096
# Pivots of the suffix filter: how many shingles lie between them.
PIVOTS = 32


def _sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    for words in scan(column):
        yield from shingle_sets(words, size)


def _cell(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - CELLS_LOG2)).astype(np.int64)


def survey(docs: DataFrame, size: int) -> tuple[DataFrame, np.ndarray]:
    """One reading of all texts: (doc_id, n_shingles, sig) per row, and the counts.

    ``sig`` is a 128-bit digest of the set, NULL for an empty one.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << CELLS_LOG2, dtype=np.uint32)
        for batch in some_rows(batches):
            ns, sigs, cells = [], [], []
            for found in _sets(batch["text"], size):
                ns.append(len(found))
                sigs.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                cells.append(_cell(found))
                if len(cells) == 256:
                    counts += np.bincount(np.concatenate(cells), minlength=len(counts)).astype(np.uint32)
                    cells = []
            if cells:
                counts += np.bincount(np.concatenate(cells), minlength=len(counts)).astype(np.uint32)
            empty = pa.nulls(len(batch), pa.int32()), pa.nulls(len(batch), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(ns, pa.int64()), pa.array(sigs, pa.binary()), *empty],
                ["doc_id", "n_shingles", "sig", "chunk", "blob"],
            )
        made = blobs.emit(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(made), pa.int64()), pa.nulls(len(made), pa.int64()), pa.nulls(len(made), pa.binary()), *made.columns],
            ["doc_id", "n_shingles", "sig", "chunk", "blob"],
        )

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    both = stored(rows.mapInArrow(read, f"doc_id BIGINT, n_shingles BIGINT, sig BINARY, {blobs.SCHEMA}"), "survey")
    counts = blobs.gather(both.where("chunk IS NOT NULL").select("chunk", "blob"), 1 << CELLS_LOG2, "uint32")
    return both.where("chunk IS NULL").select("doc_id", "n_shingles", "sig"), counts


def prefix_postings(docs: DataFrame, left_out: DataFrame, counts: np.ndarray, size: int, threshold: int) -> DataFrame:
    """(key, node, n, pos) of the prefix shingles that more than one class has.

    ``left_out(doc_id)`` are the documents that are not the first of their class.
    A shingle of a heavy cell is dealt to several tasks, which then keep it
    whether or not they see a second posting.
    """
    spark = docs.sparkSession
    counted = spark.sparkContext.broadcast(counts)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counted.value
        usual = 2 * int(table.mean())
        for batch in some_rows(batches):
            ns, keys, heavy = [], [], []
            for found in _sets(batch["text"], size):
                n = len(found)
                common = table[_cell(found)]
                first = np.lexsort((found, common))[: n - (threshold * n + 99) // 100 + 1] if n else slice(0)
                ns.append(n)
                keys.append(found[first].view(np.int64))
                over = np.maximum(common[first].astype(np.int64) - usual, 0)
                heavy.append((over // POSTINGS_TOGETHER).astype(np.int32))
            at = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            flat = [np.concatenate(x) if x else np.zeros(0, t) for x, t in ((keys, np.int64), (heavy, np.int32))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(ns, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(at), pa.array(flat[0])),
                    pa.ListArray.from_arrays(pa.array(at), pa.array(flat[1])),
                ],
                ["node", "n", "keys", "heavy"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id IS NOT NULL")
    made = rows.mapInArrow(prefixes, "node BIGINT, n INT, keys ARRAY<BIGINT>, heavy ARRAY<INT>")
    firsts = made.join(left_out.withColumnRenamed("doc_id", "node"), "node", "left_anti")
    flat = firsts.select("node", "n", F.posexplode(F.arrays_zip("keys", "heavy")).alias("pos", "at")).selectExpr(
        "node", "n", "pos", "at.keys AS key", "at.heavy AS heavy"
    )
    # the postings of a cell are dealt to one group more for every POSTINGS_TOGETHER
    # counts that it has beyond twice the mean
    dealt = flat.withColumn("part", F.expr("pmod(hash(node), heavy + 1)"))
    seen = dealt.selectExpr("*", "count(*) OVER (PARTITION BY key, part) AS together")
    return seen.where("heavy > 0 OR together > 1").select("key", "node", "n", "pos")


def _sets_of(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(node, elements, bins) of the documents that may be in ``nodes``.

    Membership is asked of a Bloom filter of a fixed size, so texts are not
    shuffled; what it lets through by mistake meets no pair later.
    """
    wanted = docs.sparkSession.sparkContext.broadcast(blobs.bloom(nodes))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in some_rows(batches):
            ids = batch["doc_id"].to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(blobs.may_hold(wanted.value, ids.view(np.uint64))))
            sets = list(_sets(batch["text"], size)) if len(batch) else []
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "elements"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id IS NOT NULL")
    return rows.mapInArrow(read, "node BIGINT, elements BINARY")


def suffix_bound(a: np.ndarray, b: np.ndarray) -> int:
    """At most so many common elements: fixed pivots cut both sorted suffixes, and
    between two pivots there are at most as many as the shorter part has."""
    pivots = (np.arange(1, PIVOTS, dtype=np.uint64) << np.uint64(64 - 5)).astype(np.uint64)
    cut_a = np.diff(np.concatenate([[0], np.searchsorted(a, pivots), [len(a)]]))
    cut_b = np.diff(np.concatenate([[0], np.searchsorted(b, pivots), [len(b)]]))
    return int(np.minimum(cut_a, cut_b).sum())


def is_link(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    """100 |A n B| >= threshold |A u B|, the suffix filter before the count."""
    both = len(a) + len(b)
    if (100 + threshold) * suffix_bound(a, b) < threshold * both:
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= threshold * (both - common)


def verified(docs: DataFrame, pairs: DataFrame, size: int, threshold: int) -> DataFrame:
    """The pairs (a, b) that are linked; each pair's two sets meet once."""
    nodes = pairs.selectExpr("explode(array(a, b)) AS node").distinct()
    sets = _sets_of(docs, nodes, size).join(nodes, "node", "left_semi").dropDuplicates(["node"])
    sets = stored(sets, "sets")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in some_rows(batches):
            keep = [
                is_link(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), threshold)
                for x, y in zip(batch["x"], batch["y"])
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    met = pairs.join(sets.selectExpr("node AS a", "elements AS x"), "a").join(sets.selectExpr("node AS b", "elements AS y"), "b")
    return met.select("a", "b", "x", "y").mapInArrow(check, "a BIGINT, b BIGINT")


# Length filter, then positional filter.  A pair needs t (|A| + |B|) / (100 + t) common
# shingles; at the first common one that many, itself included, must be left in both.
MAY_LINK = (
    "100 * least(a_n, b_n) >= {t} * greatest(a_n, b_n)"
    " AND (100 + {t}) * least(a_n - a_pos, b_n - b_pos) >= {t} * (a_n + b_n)"
)


def similar_documents(docs: DataFrame, size: int = SHINGLE_WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs(doc_id, text)``.

    ``component_id`` is the smallest doc_id that links lead to, the document
    itself included.  A NULL or empty text, or one without words, has 0 shingles
    and no link; a text of fewer than ``size`` words has one.  Repeated rows come
    out as often as they came in; rows that share a doc_id are one document, for
    which any of its texts may speak.  A NULL doc_id takes part in nothing and has
    a NULL component.  Other columns are not looked at.
    """
    rows, counts = survey(docs, size)
    classes = rows.where("sig IS NOT NULL AND doc_id IS NOT NULL").groupBy("sig").agg(F.min("doc_id").alias("first"))
    node = F.when(F.col("doc_id").isNotNull(), F.coalesce("first", "doc_id"))
    known = rows.join(classes, "sig", "left").select("doc_id", "n_shingles", node.alias("node"))
    known = stored(known, "classes")
    left_out = stored(known.where("doc_id <> node").select("doc_id").distinct(), "copies")
    postings = stored(prefix_postings(docs, left_out, counts, size, threshold).dropDuplicates(["key", "node"]), "postings")
    comp = linked_components(
        postings, MAY_LINK.format(t=threshold), lambda pairs: verified(docs, pairs, size, threshold)
    )
    if comp is None:
        return known.select("doc_id", "n_shingles", F.col("node").alias("component_id"))
    joined = known.join(comp.withColumnRenamed("node", "member"), F.col("node") == F.col("member"), "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("comp", "node").alias("component_id"))


def first_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that are linked to one with a smaller id."""
    found = similar_documents(docs, **options).where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)
