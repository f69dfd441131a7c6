"""Toxicity by subword bags: word vectors that are shared sums of n-gram vectors.

A word is the average of the vectors of itself and of its character n-grams, a
text the average of its words, and a linear softmax tells the two classes apart;
vectors and softmax are trained together.  A misspelling that was never seen
still has most of its n-grams, so it lands near the word it was made from.

All of it is linear in the n-gram vectors, so a trained model is one number per
n-gram bucket (the vector times the difference of the two class weights) and a
bias, and scoring a corpus is a table look-up per byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bytesift.llm.text import column_bytes, mix, powers, scan, some_rows

BUCKETS_LOG2 = 20
GRAMS = (3, 4, 5)
DIMENSIONS = 4
# At most this many labelled documents of each class are fitted on: those with
# the smallest hash of their id, whatever the size of the corpus.  Their whole
# texts are read.
FIT_ROWS = 2000
# A subword gets a vector if its presence tells the classes apart in the sample:
# by so many standard deviations of the difference of the two shares of documents.
LEAST_Z = 3.5
EPOCHS = 300
RATE = 0.05
THRESHOLD = 0.5

# Words looked at together.
AT_ONCE = 1 << 15


def byte_hashes() -> np.ndarray:
    """A number per byte, the same for a letter A-Z and its lower case."""
    values = mix(np.arange(256, dtype=np.uint64) + np.uint64(77)) | np.uint64(1)
    values[65:91] = values[97:123]
    return values


_BYTES = byte_hashes()


def subwords(data: np.ndarray, start: np.ndarray, end: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each subword, and the position of the word that has it.

    ``data`` holds the words at ``start:end``, ``words`` their hashes.  Subwords
    are the word, its runs of n bytes, and its first and last n - 1 bytes with a
    mark for the word's border.
    """
    up, down = powers(len(data) + 1)
    shift = np.uint64(64 - BUCKETS_LOG2)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[data] * up[: len(data)], out=sums[1:])
    length = end - start
    every = np.arange(len(start), dtype=np.int32)
    buckets, owners = [(mix(words) >> shift).astype(np.int32)], [every]

    def add(at: np.ndarray, n: int, salt: int, owner: np.ndarray) -> None:
        code = mix((sums[at + n] - sums[at]) * down[at] + np.uint64(salt))
        buckets.append((code >> shift).astype(np.int32))
        owners.append(owner)

    for n in GRAMS:
        count = np.maximum(length - n + 1, 0)
        owner = np.repeat(every, count)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        add(start[owner] + step, n, n, owner)
        edge = np.flatnonzero(length >= n - 1)
        add(start[edge], n - 1, 1000 + n, every[edge])
        add(end[edge] - (n - 1), n - 1, 2000 + n, every[edge])
    return np.concatenate(buckets), np.concatenate(owners)


def _word_groups(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text of each word, owners of subwords, their buckets), some words at once."""
    data, offsets = column_bytes(column)
    for words in scan(column):
        text = np.repeat(np.arange(len(words)), np.diff(words.at)) + words.row
        shift = offsets[text]
        start, end = words.start + shift, words.end + shift
        for low in range(0, len(text), AT_ONCE):
            part = slice(low, low + AT_ONCE)
            first = start[low]
            piece = data[first : end[part][-1]]
            buckets, owners = subwords(piece, start[part] - first, end[part] - first, words.hashes[part])
            yield text[part], owners, buckets


def bag(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text the distinct buckets of its subwords and their weights.

    The weights of a text sum to 1 (to 0 without words): each word weighs the
    same, and so does each subword within its word.
    """
    n = len(column)
    keys, weights = [[] for _ in range(n)], [[] for _ in range(n)]
    for text, owners, buckets in _word_groups(column):
        each = 1.0 / np.bincount(owners, minlength=len(text))
        code = text[owners].astype(np.int64) << BUCKETS_LOG2 | buckets
        found, place = np.unique(code, return_inverse=True)
        total = np.bincount(place, weights=each[owners])
        owner = found >> BUCKETS_LOG2
        for i in np.unique(owner):
            low, high = np.searchsorted(owner, [i, i + 1])
            keys[i].append((found[low:high] & ((1 << BUCKETS_LOG2) - 1)).astype(np.int32))
            weights[i].append(total[low:high])
    out = []
    for k, w in zip(keys, weights):
        if not k:
            out.append((np.zeros(0, np.int32), np.zeros(0, np.float32)))
            continue
        found, place = np.unique(np.concatenate(k), return_inverse=True)
        total = np.bincount(place, weights=np.concatenate(w))
        out.append((found, (total / total.sum()).astype(np.float32)))
    return out


@dataclass(frozen=True)
class Model:
    """``table[b]`` is what a subword in bucket b adds to the log-odds; ``bias`` the rest."""

    table: np.ndarray
    bias: float


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, prior: float = 0.5, seed: int = 5) -> Model:
    """Fit vectors and softmax on whole bags, both classes weighing the same in all.

    A fifth of the rows is kept aside; the epoch with the least loss there is
    taken.  Steps are scaled per layer and not per number, so what many texts
    share moves more than what one text has.  ``prior`` is the share of class 1
    in the corpus and shifts the bias.  Without rows of both classes the model
    has no vectors and says the one class it has seen (0 without any row).
    """
    size = 1 << BUCKETS_LOG2
    full = [i for i, b in enumerate(bags) if len(b[0])]
    labels = labels[full].astype(np.float32) if full else np.zeros(0, np.float32)
    if not full or labels.min() == labels.max():
        return Model(np.zeros(size, np.float32), 20.0 if full and labels[0] else -20.0)
    n = len(full)
    rng = np.random.default_rng(seed)
    aside = rng.random(n) < 0.2
    if len(set(labels[aside])) < 2 or len(set(labels[~aside])) < 2:
        aside = np.zeros(n, dtype=bool)
    test = aside if aside.any() else ~aside
    # counted bag by bag: only what gets a vector is ever put together
    ones, every = np.zeros(size), np.zeros(size)
    for i, label, left_out in zip(full, labels, aside):
        if not left_out:
            every[bags[i][0]] += 1  # a bag has each bucket once
            if label:
                ones[bags[i][0]] += 1
    n_ones, n_fit = labels[~aside].sum(), (~aside).sum()
    mean = every / n_fit
    spread = np.sqrt(mean * (1 - mean) * (1 / n_ones + 1 / (n_fit - n_ones))) + 1e-9
    z = np.abs((ones / n_ones - (every - ones) / (n_fit - n_ones)) / spread)
    telling = z >= min(LEAST_Z, z[every > 0].max())
    kept = [telling[bags[i][0]] for i in full]
    keys = np.concatenate([bags[i][0][k] for i, k in zip(full, kept)])
    weights = np.concatenate([bags[i][1][k] for i, k in zip(full, kept)])
    row_of = np.repeat(np.arange(n, dtype=np.int32), [int(k.sum()) for k in kept])
    used, local = np.unique(keys, return_inverse=True)
    m = len(used)
    wanted = np.stack([1 - labels, labels], axis=1)

    def shares(rows: np.ndarray) -> np.ndarray:
        one, zero = (labels * rows).sum(), ((1 - labels) * rows).sum()
        return (np.where(labels == 1, 0.5 / one, 0.5 / zero) * rows).astype(np.float32)

    fit_share, test_share = shares(~aside), shares(test)
    params = [
        rng.normal(0, 0.01, (m, DIMENSIONS)).astype(np.float32),
        rng.normal(0, 0.5, (DIMENSIONS, 2)).astype(np.float32),
        np.zeros(2, np.float32),
    ]
    pace = [np.zeros_like(p) for p in params]
    # a subword's steps are measured in its usual weight where it is found
    usual = np.bincount(local, weights=weights, minlength=m) / np.bincount(local, minlength=m)
    stretch = (1 / usual**2)[:, None]
    best, least = None, np.inf
    for _ in range(EPOCHS):
        vectors, softmax, bias = params
        hidden = np.stack(
            [np.bincount(row_of, weights=vectors[:, d][local] * weights, minlength=n) for d in range(DIMENSIONS)], axis=1
        )
        logits = hidden @ softmax + bias
        logits -= logits.max(axis=1, keepdims=True)
        odds = np.exp(logits)
        odds /= odds.sum(axis=1, keepdims=True)
        loss = -(test_share * np.log(np.maximum((odds * wanted).sum(axis=1), 1e-12))).sum()
        if loss < least:
            least, best = loss, [p.copy() for p in params]
        slope = (odds - wanted) * fit_share[:, None]
        back = (slope @ softmax.T).astype(np.float32)
        grown = np.stack(
            [np.bincount(local, weights=back[:, d][row_of] * weights, minlength=m) for d in range(DIMENSIONS)], axis=1
        )
        for p, g, v in zip(params, [grown * stretch, hidden.T @ slope, slope.sum(axis=0)], pace):
            v *= 0.9
            v += 0.1 * g / (np.sqrt((g * g).mean()) + 1e-12)
            p -= RATE * v
    vectors, softmax, bias = best
    table = np.zeros(size, np.float32)
    table[used] = vectors @ (softmax[:, 1] - softmax[:, 0])
    prior = min(max(prior, 1e-4), 1 - 1e-4)
    return Model(table, float(bias[1] - bias[0] + np.log(prior / (1 - prior))))


def log_odds(column: pa.Array, model: Model) -> np.ndarray:
    """The log-odds of class 1 of each text; a text without words has the bias."""
    total, words = np.zeros(len(column)), np.zeros(len(column))
    for text, owners, buckets in _word_groups(column):
        score = np.bincount(owners, weights=model.table[buckets]) / np.bincount(owners)
        total += np.bincount(text, weights=score, minlength=len(column))
        words += np.bincount(text, minlength=len(column))
    return total / np.maximum(words, 1) + model.bias


def held_out(doc_id: str = "doc_id") -> Column:
    """The fifth of the ids whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def label_sample(labels: DataFrame, column: str, rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, label) of up to ``rows`` labelled ids per class that are not held out.

    The sample is the smallest hashes of the ids.  A NULL id or label is left
    out; an id that is labelled more than once has its largest label.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & ~held_out())
    one = known.groupBy("doc_id").agg(F.max(F.col(column).cast("int")).alias("label"))
    parts = [one.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for c in (0, 1)]
    return parts[0].unionByName(parts[1])


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic", rows: int = FIT_ROWS) -> Model:
    """Train on a bounded sample of labelled documents; their bags come to the driver."""
    sample = label_sample(labels, column, rows)
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def bags_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 64):
                part = batch.slice(low, 64)
                bags = bag(part["text"])
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        part["label"],
                        pa.array([k.tobytes() for k, _ in bags], pa.binary()),
                        pa.array([w.tobytes() for _, w in bags], pa.binary()),
                    ],
                    ["doc_id", "label", "keys", "weights"],
                )

    made = chosen.mapInArrow(bags_of, "doc_id BIGINT, label INT, keys BINARY, weights BINARY")
    found = [(r["doc_id"], r["label"], bytes(r["keys"]), bytes(r["weights"])) for r in made.toLocalIterator()]
    found.sort()  # the order of rows must not change the sums
    bags = [(np.frombuffer(k, np.int32), np.frombuffer(w, np.float32)) for _, _, k, w in found]
    seen = labels.where(~held_out()).agg(F.avg(F.col(column).cast("double")).alias("share")).first()["share"]
    return train(bags, np.array([label for _, label, _, _ in found]), 0.5 if seen is None else seen)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, texts read whole.

    A NULL or empty text scores the model's bias; equal texts score the same.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            odds = 1 / (1 + np.exp(-np.clip(log_odds(batch["text"], shared.value), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(odds)], ["doc_id", "held_out", "score"])

    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(scored, f"doc_id {doc_type}, held_out BOOLEAN, score DOUBLE")
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not predicted toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in some_rows(batches):  # what goes back is a copy of the texts
            text = batch.column(at)
            # the same comparison as in ``score``
            odds = 1 / (1 + np.exp(-np.clip(log_odds(text, shared.value), -30, 30)))
            yield batch.filter(pa.array(odds < THRESHOLD))

    at = docs.columns.index("text")
    return docs.mapInArrow(keep, docs.schema)
