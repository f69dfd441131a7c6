"""Periodic runs: stretches of words that go on repeating themselves.

The documents of a batch share one enhanced suffix array (suffix array, its inverse
ISA, and LCP), made by doubling in numpy.  A run of period q that ends in front of
word e shows as a branching tandem: the suffixes at i = e - 2q and i + q have exactly q
words in common, so they stand on two sides of an LCP interval of depth q.  For each
interval the suffixes of its smaller side are taken, and ISA[i + depth] and
ISA[i - depth] tell whether the partner stands on the other side; n log n checks in
all, on ranges of the arrays, without nodes of a tree.  Each square found is rotated to
the left as far as words stay equal, and squares that fill the same stretch are merged
into the run of the smallest period.

A document is whole in one task (its cell is), and documents never meet: their words
are numbered by document first.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bytesift.llm.text import some_rows

MIN_WORDS = 24
MIN_REPEATS = 3

# Words that share one suffix array (a longer document has its own), and the
# suffixes that are looked at together.
WORDS_TOGETHER = 1 << 17
SUFFIXES_TOGETHER = 1 << 20


def _doubled(ranks: np.ndarray, width: int) -> np.ndarray:
    """The ranks of stretches of twice ``width`` words."""
    key = ranks.astype(np.int64) * (len(ranks) + 1)
    key[:-width] += ranks[width:] + 1
    order = np.argsort(key)
    step = np.zeros(len(key), dtype=np.int32)
    step[1:] = np.diff(key[order]) != 0
    out = np.empty(len(key), dtype=np.int32)
    out[order] = np.cumsum(step, dtype=np.int32)
    return out


def _in_common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, back: bool = False) -> np.ndarray:
    """How many words are equal from places ``a`` and ``b`` on; with ``back`` in front of them.

    ``levels[k]`` tells equal stretches of 2^k words, and has -1 behind its last place.
    """
    end = len(levels[0]) - 1
    found = np.zeros(len(a), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        if back:
            x, y = a - found - (1 << k), b - found - (1 << k)
            same = (x >= 0) & (y >= 0) & (levels[k][np.maximum(x, 0)] == levels[k][np.maximum(y, 0)])
        else:
            same = levels[k][np.minimum(a + found, end)] == levels[k][np.minimum(b + found, end)]
        found += same.astype(np.int64) << k
    return found


def _sides(lcp: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first, at, end) of each LCP interval: it is cut at ``at`` into the suffixes
    first..at-1 and at..end-1; of equal depths the leftmost cuts first."""
    n = len(lcp)
    at = np.flatnonzero(lcp > 0)
    depth = lcp[at]
    least = [lcp]
    while 2 << (len(least) - 1) <= n:
        half = 1 << (len(least) - 1)
        least.append(np.minimum(least[-1][:-half], least[-1][half:]))
    first, end = at.copy(), at + 1
    for k in range(len(least) - 1, -1, -1):
        low = np.maximum(first - (1 << k), 0)
        first = np.where((first - (1 << k) >= 1) & (least[k][low] > depth), low, first)
        high = np.minimum(end, len(least[k]) - 1)
        end = np.where((end + (1 << k) <= n) & (least[k][high] >= depth), end + (1 << k), end)
    return first - 1, at, end


def _tandems(order: np.ndarray, place: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, q) of all places whose suffixes i and i + q have exactly q words in common."""
    first, at, end = _sides(lcp)
    n, depth = len(order), lcp[at].astype(np.int64)
    left = at - first <= end - at  # the smaller side
    low, size = np.where(left, first, at), np.minimum(at - first, end - at)
    far, to = np.where(left, at, first), np.where(left, end, at)
    upto = np.cumsum(size)
    found_i, found_q, begun = [], [], 0
    while begun < len(at):
        over = int(upto[begun - 1]) if begun else 0
        stop = max(begun + 1, int(np.searchsorted(upto, over + SUFFIXES_TOGETHER, side="right")))
        part = slice(begun, stop)
        of = np.repeat(np.arange(begun, stop), size[part])
        inside = np.arange(len(of)) - np.repeat(upto[part] - size[part] - over, size[part])
        i, q = order[low[of] + inside].astype(np.int64), depth[of]
        for partner, start in ((i + q, i), (i - q, i - q)):
            known = (partner >= 0) & (partner < n)
            where = place[np.where(known, partner, 0)]
            good = known & (where >= far[of]) & (where < to[of])
            found_i.append(start[good])
            found_q.append(q[good])
        begun = stop
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *found_i]), np.concatenate([none, *found_q])


def find_runs(
    words: list[np.ndarray], min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS
) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each list of word numbers, by start, then period.

    A run has at least ``min_words`` words and ``min_repeats`` (2 or more) periods.
    """
    out: list[list[tuple[int, int, int]]] = [[] for _ in words]
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    if not sizes.sum():
        return out
    doc = np.repeat(np.arange(len(words)), sizes)
    start_of = np.cumsum(sizes) - sizes
    at = np.arange(len(doc)) - start_of[doc]
    _, ranks = np.unique((doc << 40) | np.concatenate(words).astype(np.int64), return_inverse=True)
    levels = [ranks.reshape(-1).astype(np.int32)]
    # the first words of a run come again one period on: as many as it has beyond a period
    recurring = max(1, min_words - min_words // min_repeats)
    while levels[-1].max() + 1 < len(doc):
        width = 1 << (len(levels) - 1)
        if width <= recurring < 2 * width:
            again = np.zeros(len(words), dtype=bool)
            again[doc[np.bincount(levels[-1])[levels[-1]] > 1]] = True
            kept = again[doc]
            if not kept.any():
                return out
            levels, doc, at = [v[kept] for v in levels], doc[kept], at[kept]
            levels[-1] = np.unique(levels[-1], return_inverse=True)[1].reshape(-1).astype(np.int32)
        if levels[-1].max() + 1 < len(doc):
            levels.append(_doubled(levels[-1], width))
    place = levels[-1]
    order = np.empty(len(place), dtype=np.int64)
    order[place] = np.arange(len(place))
    levels = [np.append(v, np.int32(-1)) for v in levels]
    lcp = np.zeros(len(order), dtype=np.int64)
    lcp[1:] = _in_common(levels, order[:-1], order[1:])
    i, q = _tandems(order, place, lcp)
    turned = _in_common(levels, i, i + q, back=True)
    length = turned + 2 * q
    good = (length >= min_words) & (length >= min_repeats * q)
    start, length, q = (i - turned)[good], length[good], q[good]
    by = np.lexsort((q, length, start))  # of squares that fill one stretch the smallest period
    start, length, q = start[by], length[by], q[by]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (np.diff(start) != 0) | (np.diff(length) != 0)
    start, length, q = start[new], length[new], q[new]
    for k in np.lexsort((q, start)).tolist():
        out[doc[start[k]]].append((int(at[start[k]]), int(length[k]), int(q[k])))
    return out


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(words)
    drop = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return b" ".join([w for w, d in zip(words, np.cumsum(drop).tolist()) if not d])


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> DataFrame:
    """doc_id, n_words, runs and collapsed of every row of ``docs(doc_id, text)``.

    ``runs`` is an array of structs (start, length, period), counted in words from 0, by
    start, then period: the stretches whose words repeat with that smallest period, at
    least ``min_repeats`` times and over ``min_words`` words, and that neither neighbour
    goes on.  ``collapsed`` has the words, joined by one space, without those that a run
    holds after its first period.  Words are told apart by their bytes.

    A NULL or empty text, or one without words, has no run and collapses to the empty
    text.  Repeated rows, and rows with a NULL doc_id, come out as they came in.  Other
    columns are not looked at.
    """
    if min_repeats < 2:
        raise ValueError("a run repeats at least twice")
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("n_words", pa.int64()),
            ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
            ("collapsed", pa.string()),
        ]
    )

    def made(ids: list, texts: list[list[bytes]], codes: list[np.ndarray]) -> pa.RecordBatch:
        found = find_runs(codes, min_words, min_repeats)
        columns = [
            ids,
            [len(t) for t in texts],
            [[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in found],
            [_collapsed(t, runs).decode("utf-8") for t, runs in zip(texts, found)],
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in some_rows(batches):
            ids, texts, codes, total = [], [], [], 0
            number: dict[bytes, int] = defaultdict(count().__next__)
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].cast(pa.large_binary())):
                words = (text.as_py() or b"").split()  # at the same six bytes of white space
                if texts and total + len(words) > WORDS_TOGETHER:
                    yield made(ids, texts, codes)
                    ids, texts, codes, total = [], [], [], 0
                    number = defaultdict(count().__next__)
                ids.append(doc)
                texts.append(words)
                codes.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
                total += len(words)
            if texts:
                yield made(ids, texts, codes)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(
        read,
        "doc_id BIGINT, n_words BIGINT, runs ARRAY<STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>>, collapsed STRING",
    )


def strongest(runs: str) -> F.Column:
    """The run of the greatest exact length / period; of equal ones the first in the array."""
    better = "IF(best IS NULL OR r.length * best.period > best.length * r.period, r, best)"
    return F.expr(f"aggregate(slice({runs}, 2, greatest(1, size({runs}))), get({runs}, 0), (best, r) -> {better})")
