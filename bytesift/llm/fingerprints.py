"""Document fingerprints by MinHash.

Word shingles are hashed; each of K universal hash functions permutes the hashes
and the least value of a text is one slot of its signature.  Two texts agree in a
slot with a probability equal to the Jaccard similarity of their shingle sets.
A fingerprint is the signature written as hexadecimal digits, 16 bits per slot.
Bands of the full signature are joined in Spark to find similar documents, and the
similarity of what they bring together is verified on the sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bytesift.llm.jaccard import verified
from bytesift.llm.links import linked_components
from bytesift.llm.store import stored
from bytesift.llm.text import constants, mix, scan, shingle_sets, some_rows

SLOTS = 128
SHINGLE_WORDS = 5
# 32 bands of 4 slots: a pair of similarity 0.8 is missed once in 30 million times.
BANDS = 32
THRESHOLD = 80  # of 100

_A, _B = constants(21, SLOTS), constants(22, SLOTS)


def signatures(column: pa.Array, size: int = SHINGLE_WORDS) -> np.ndarray:
    """One row of SLOTS 32-bit values per text; all ones for a text without words."""
    rows = []
    for words in scan(column):
        for found in shingle_sets(words, size):
            least = np.full(SLOTS, 0xFFFFFFFF, dtype=np.uint32)
            for low in range(0, len(found), 4096):  # bounds the table of permuted values
                part = found[low : low + 4096]
                permuted = (_A[:, None] * part[None, :] + _B[:, None]) >> np.uint64(32)
                np.minimum(least, permuted.min(axis=1).astype(np.uint32), out=least)
            rows.append(least)
    return np.array(rows, dtype=np.uint32).reshape(len(rows), SLOTS)


def written(signature: np.ndarray) -> list[str]:
    """16 bits of each slot in hexadecimal; empty for a text without words."""
    short = (mix(signature.astype(np.uint64)) >> np.uint64(48)).astype(">u2")
    blank = (signature == 0xFFFFFFFF).all(axis=1)
    return ["" if b else row.tobytes().hex() for row, b in zip(short, blank)]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of equal slots of the written fingerprints, row by row."""
    shorten = [(mix(s.astype(np.uint64)) >> np.uint64(48)) for s in (a, b)]
    return (shorten[0] == shorten[1]).mean(axis=1)


def _with_next(docs: DataFrame) -> tuple[DataFrame, str]:
    """Rows dealt to ranges of doc_id, sorted, each range with the row that follows.

    Ranges are cut at quantiles of the ids, as many as there are shuffle
    partitions.  The first row of a range is sent to the range before it as well
    (the very first one to the last range), so each text is shuffled once and
    its follower is in the same task.
    """
    spark = docs.sparkSession
    n = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")) * 4)
    least = "CAST(-9223372036854775808 AS BIGINT)"
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.expr(f"coalesce(CAST(doc_id AS BIGINT), {least})").alias("_at"))
    shares = [i / n for i in range(1, n)]
    cuts = rows.select("_at").agg(F.percentile_approx("_at", shares, 10_000).alias("c")).first()["c"] or []
    cuts = sorted(set(cuts))
    bounds = "array(" + ", ".join(f"{c}L" if c > -(2**63) else least for c in cuts) + ")" if cuts else "CAST(array() AS ARRAY<BIGINT>)"
    rows = rows.withColumn("_range", F.expr(f"size(filter({bounds}, c -> c <= _at))"))
    firsts = sorted((r["_range"], r["first"]) for r in rows.groupBy("_range").agg(F.min("_at").alias("first")).collect())
    before = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}
    starts = spark.createDataFrame(list(before.items()), "_at BIGINT, _before INT")
    marked = rows.join(F.broadcast(starts), "_at", "left")
    to = F.expr(
        "IF(_before IS NULL, array(named_struct('to', _range, 'extra', false)),"
        " array(named_struct('to', _range, 'extra', false), named_struct('to', _before, 'extra', true)))"
    )
    dealt = marked.withColumn("_to", F.explode(to)).select("doc_id", "text", "_at", "_to.to", "_to.extra")
    placed = dealt.repartition(n, "to").sortWithinPartitions("to", "extra", "_at", "text")
    return placed.select("doc_id", "text", "to", "extra"), docs.schema["doc_id"].dataType.simpleString()


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited and near_next.

    The edited text has the last n_chars // 4 code points replaced by the first as
    many of the next document in ascending order of doc_id (all of it if it is
    shorter); after the last comes the first.  NULL is an empty text and a NULL id
    comes first; equal ids follow each other by text.  Texts without words have
    an empty fingerprint, and two of those are alike.
    """
    placed, doc_type = _with_next(docs)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        """(doc_id, text, next text) in lists of about a MiB of text."""
        held, out, size = None, [], 0
        for batch in batches:
            for doc, text, to, extra in zip(*[batch[c].to_pylist() for c in ("doc_id", "text", "to", "extra")]):
                if held is not None and held[2] == to:
                    out.append((held[0], held[1], text))
                    size += len(text)
                    if size > 1 << 20:
                        yield out
                        out, size = [], 0
                held = None if extra else (doc, text, to)
        if out:
            yield out

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in pairs(some_rows(batches, 256)):
            ids, texts, nexts = zip(*group)
            edited = [t[: len(t) - len(t) // 4] + n[: len(t) // 4] for t, n in zip(texts, nexts)]
            own, changed = signatures(pa.array(texts)), signatures(pa.array(edited))
            after = np.concatenate([own[1:], own[-1:]])  # the next text is mostly the next row
            other = [i for i in range(len(texts)) if i + 1 == len(texts) or nexts[i] != texts[i + 1]]
            if other:
                after[other] = signatures(pa.array([nexts[i] for i in other]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]),
                    pa.array(written(own)),
                    pa.array(written(changed)),
                    pa.array(likeness(own, changed)),
                    pa.array(likeness(own, after)),
                ],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    return placed.mapInArrow(
        read,
        f"doc_id {doc_type}, n_chars BIGINT, edited_sha256 STRING, fingerprint STRING, edited_fingerprint STRING,"
        " near_edited DOUBLE, near_next DOUBLE",
    )


def similar(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id and component_id: what is joined by verified pairs of equal bands.

    Texts with equal signatures are one class.  A band shared by many is not
    paired off: its members are compared with hubs until their components are
    settled.  A pair that no band brings together is missed (see BANDS).
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in some_rows(batches):
            found = signatures(batch["text"])
            width = SLOTS // BANDS
            salt = constants(23, width)
            keys = mix((found.reshape(len(found), BANDS, width).astype(np.uint64) * salt).sum(axis=2) + np.arange(BANDS, dtype=np.uint64))
            sigs = [None if (s == 0xFFFFFFFF).all() else s.tobytes() for s in found]
            bands = pa.ListArray.from_arrays(
                pa.array(np.arange(len(found) + 1, dtype=np.int32) * BANDS), pa.array(keys.reshape(-1).view(np.int64))
            )
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(sigs, pa.binary()), bands], ["doc_id", "sig", "bands"])

    rows = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id IS NOT NULL")
    known = stored(rows.mapInArrow(read, "doc_id BIGINT, sig BINARY, bands ARRAY<BIGINT>"), "signatures")
    first = known.where("sig IS NOT NULL").groupBy("sig").agg(F.min("doc_id").alias("first"))
    classes = stored(
        known.select("doc_id", "sig").join(first, "sig", "left").select("doc_id", F.coalesce("first", "doc_id").alias("node")), "classes"
    )
    reps = known.where("sig IS NOT NULL").join(classes.where("doc_id = node").select("doc_id").distinct(), "doc_id", "left_semi")
    postings = stored(
        reps.select(F.explode("bands").alias("key"), F.col("doc_id").alias("node")).distinct(), "postings"
    )
    comp = linked_components(postings, "true", lambda pairs: verified(docs, pairs, SHINGLE_WORDS, threshold))
    if comp is None:
        return classes.select("doc_id", F.col("node").alias("component_id"))
    joined = classes.join(comp.withColumnRenamed("node", "member"), F.col("node") == F.col("member"), "left")
    return joined.select("doc_id", F.coalesce("comp", "node").alias("component_id"))
