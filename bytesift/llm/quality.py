"""A quality classifier on random-indexing word vectors.

Every token has a sparse index vector, a few +1 and -1 places that follow from its
hash.  The vector of a token is the sum of the index vectors of its neighbours
over the whole corpus, so tokens used alike are alike.  A document is the pooled
(mean and spread) vectors of its tokens; a two-layer network tells its quality,
and a temperature fitted on rows kept aside makes its probabilities honest.

A token is a run of letters, digits and bytes beyond ASCII, or a run of one of the
other marks; tokens share a bounded number of rows by their hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bytesift.llm import blobs
from bytesift.llm.text import STRETCH, column_bytes, mix, powers
from bytesift.llm.toxicity import held_out, label_sample

ROWS_LOG2 = 15
DIMENSIONS = 32
# Non-zero places of an index vector, and neighbours on each side.
PLACES = 4
REACH = 2
HIDDEN = 32
EPOCHS = 400
RATE = 0.01
# At most this many labelled documents of each class are fitted on.
FIT_ROWS = 3000
THRESHOLD = 0.3

# 0 for white space, 1 for letters, digits and bytes beyond ASCII, else a kind each
_KIND = np.arange(256, dtype=np.int16)
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_BYTES = mix(np.arange(256, dtype=np.uint64) + np.uint64(991)) | np.uint64(1)


def tokens(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, row of the table) of each token, about a stretch of bytes at once."""
    data, offsets = column_bytes(column)
    low, n = int(offsets[0]), len(offsets) - 1
    while low < offsets[-1]:
        high = min(int(offsets[-1]), low + STRETCH)
        if high < offsets[-1]:  # not inside a token, if there is a border near
            back = np.flatnonzero(_KIND[data[max(low + 1, high - 4096) : high]] == 0)
            high = max(low + 1, high - 4096) + int(back[-1]) if len(back) else high
        piece = data[low:high]
        kind = _KIND[piece]
        new = np.ones(len(piece), dtype=bool)
        new[1:] = kind[1:] != kind[:-1]
        cuts = offsets[(offsets > low) & (offsets < high)] - low
        new[cuts] = True
        start = np.flatnonzero(new)
        end = np.append(start[1:], len(piece))
        real = kind[start] != 0
        start, end = start[real], end[real]
        up, down = powers(len(piece))
        sums = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum(_BYTES[piece] * up[: len(piece)], out=sums[1:])
        code = mix((sums[end] - sums[start]) * down[start])
        text = np.searchsorted(offsets, start + low, side="right") - 1
        yield np.minimum(text, n - 1), (code >> np.uint64(64 - ROWS_LOG2)).astype(np.int64)
        low = high


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the index vector of each row of the table."""
    row = np.arange(1 << ROWS_LOG2, dtype=np.uint64)[:, None]
    code = mix(row * np.uint64(PLACES) + np.arange(PLACES, dtype=np.uint64) + np.uint64(1 << 40))
    return (code % np.uint64(DIMENSIONS)).astype(np.int64), np.where(code >> np.uint64(63), 1, -1).astype(np.int32)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The table of all tokens of all texts: one vector of length 1 per row.

    Its size is fixed by ROWS_LOG2 and DIMENSIONS; tasks add up their own tables
    and Spark adds those.  The sums are whole numbers, so reruns agree.
    """
    size = (1 << ROWS_LOG2) * DIMENSIONS

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        table = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for text, row in tokens(batch["text"]):
                for reach in range(1, REACH + 1):
                    same = text[reach:] == text[:-reach]
                    left, right = row[:-reach][same], row[reach:][same]
                    for a, b in ((left, right), (right, left)):
                        pair, times = np.unique(a << ROWS_LOG2 | b, return_counts=True)
                        a, b = pair >> ROWS_LOG2, pair & ((1 << ROWS_LOG2) - 1)
                        for k in range(PLACES):
                            at = a * DIMENSIONS + places[b, k]
                            table += np.bincount(at, weights=signs[b, k] * times, minlength=size).astype(np.int64)
        yield blobs.emit(table)

    table = blobs.gather(docs.select("text").mapInArrow(read, blobs.SCHEMA), size, "int64")
    vectors = table.reshape(-1, DIMENSIONS).astype(np.float32)
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def pooled(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Per text the mean of its tokens' vectors and the spread around it; zeros
    for a text without tokens."""
    n = len(column)
    total, squares, count = np.zeros((n, DIMENSIONS)), np.zeros((n, DIMENSIONS)), np.zeros(n)
    for text, row in tokens(column):
        pair, times = np.unique(text << ROWS_LOG2 | row, return_counts=True)
        text, row = pair >> ROWS_LOG2, pair & ((1 << ROWS_LOG2) - 1)
        held = vectors[row]
        found, at = np.unique(text, return_index=True)
        weighed = held * times[:, None]
        total[found] += np.add.reduceat(weighed, at, axis=0)
        squares[found] += np.add.reduceat(weighed * held, at, axis=0)
        count[found] += np.add.reduceat(times, at)
    count = np.maximum(count, 1)[:, None]
    mean = total / count
    return np.concatenate([mean, np.sqrt(np.maximum(squares / count - mean**2, 0))], axis=1).astype(np.float32)


@dataclass(frozen=True)
class Network:
    """Scaling of the inputs, two layers, and the temperature of the log-odds."""

    centre: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        # einsum adds in one order for every row, so equal rows score the same in any batch
        hidden = np.tanh(np.einsum("ij,jk->ik", (x - self.centre) / self.scale, self.first) + self.first_bias)
        return (np.einsum("ij,j->i", hidden, self.second) + self.second_bias) / self.temperature


def train(x: np.ndarray, y: np.ndarray, prior: float, seed: int = 8) -> Network:
    """Fit on four fifths of the rows; the rest picks the epoch and the temperature.

    Both classes weigh the same in fitting, and ``prior``, the share of class 1,
    shifts the log-odds.  With one class only, that class is always said.
    """
    width = x.shape[1]
    if not len(y) or y.min() == y.max():
        bias = 20.0 if len(y) and y[0] else -20.0
        zero = np.zeros((width, 1), np.float32)
        return Network(np.zeros(width), np.ones(width), zero, np.zeros(1), np.zeros(1), bias, 1.0)
    rng = np.random.default_rng(seed)
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    x = (x - centre) / scale
    aside = rng.random(len(y)) < 0.2
    if len(set(y[aside])) < 2 or len(set(y[~aside])) < 2:
        aside = np.ones(len(y), dtype=bool)
        fitted = aside
    else:
        fitted = ~aside
    params = [
        rng.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1),
    ]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]

    def weights(rows: np.ndarray) -> np.ndarray:
        one = y[rows].mean()
        return np.where(y[rows] == 1, 0.5 / one, 0.5 / (1 - one)) / rows.sum()

    fx, fy, fw, ax, ay, aw = x[fitted], y[fitted], weights(fitted), x[aside], y[aside], weights(aside)

    def loss(odds: np.ndarray) -> float:
        return float((aw * np.logaddexp(0, np.where(ay == 1, -odds, odds))).sum())

    best, least = None, np.inf
    for epoch in range(1, EPOCHS + 1):
        w1, b1, w2, b2 = params
        hidden = np.tanh(fx @ w1 + b1)
        slope = fw * (1 / (1 + np.exp(-(hidden @ w2 + b2[0]))) - fy)
        back = slope[:, None] * w2 * (1 - hidden**2)
        grads = [fx.T @ back + 1e-4 * w1, back.sum(axis=0), hidden.T @ slope + 1e-4 * w2, slope.sum(keepdims=True)]
        for p, g, m, v in zip(params, grads, first, second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= RATE * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.999**epoch)) + 1e-8)
        now = loss(np.tanh(ax @ params[0] + params[1]) @ params[2] + params[3][0])
        if now < least:
            least, best = now, [p.copy() for p in params]
    w1, b1, w2, b2 = best
    shift = np.log(max(prior, 1e-4) / max(1 - prior, 1e-4))
    odds = np.tanh(ax @ w1 + b1) @ w2 + b2[0]
    heat = min(np.geomspace(0.2, 5, 60), key=lambda t: loss(odds / t))
    # the prior is added after the temperature, so it is given to the bias times it
    return Network(centre, scale, w1, b1, w2, float(b2[0] + shift * heat), float(heat))


def fit(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, column: str = "quality", rows: int = FIT_ROWS) -> Network:
    """Train on a bounded sample of labelled rows that are not held out."""
    spark = docs.sparkSession
    sample = label_sample(labels, column, rows)
    held = spark.sparkContext.broadcast(vectors)
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pooled(batch["text"], held.value)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["label"], pa.array([row.tobytes() for row in x], pa.binary())], ["doc_id", "label", "x"]
            )

    found = sorted((r["doc_id"], r["label"], bytes(r["x"])) for r in chosen.mapInArrow(read, "doc_id BIGINT, label INT, x BINARY").collect())
    x = np.array([np.frombuffer(v, np.float32) for _, _, v in found]).reshape(len(found), 2 * DIMENSIONS)
    seen = labels.where(~held_out()).agg(F.avg(F.col(column).cast("double")).alias("share")).first()["share"]
    return train(x.astype(np.float64), np.array([label for _, label, _ in found]), 0.5 if seen is None else seen)


def score(docs: DataFrame, vectors: np.ndarray, network: Network) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, texts read whole.

    A NULL or empty text has the score of the zero vector; equal texts score the
    same; other columns are not looked at.
    """
    held = docs.sparkSession.sparkContext.broadcast(vectors)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            odds = network.log_odds(pooled(batch["text"], held.value))
            odds = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(odds)], ["doc_id", "held_out", "score"])

    doc_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    out = rows.mapInArrow(read, f"doc_id {doc_type}, held_out BOOLEAN, score DOUBLE")
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
