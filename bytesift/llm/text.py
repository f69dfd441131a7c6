"""Words and shingles of Arrow string columns, in vectorised numpy.

A word is a run of bytes other than blank, tab, newline, vertical tab, form feed
and carriage return (``[^\\x20\\x09-\\x0D]+``; all of them are one byte in UTF-8).
NULL counts as the empty text.  Whole texts are read: a text longer than a
stretch is hashed in several stretches, each cut at white space.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text hashed at once; bounds the memory of the helper arrays.
STRETCH = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# The first 0 to 8 bytes of a little-endian piece.
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)
# Bytes of a word after which its rest is hashed in one go.
LONG_WORD = 512


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: each input bit reaches each output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def constants(seed: int, n: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers that follow from ``seed``."""
    at = np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed) * np.uint64(1 << 32)
    return mix(at * _ODD) | np.uint64(1)


_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers 0..n of the odd multiplier and of its inverse, modulo 2^64."""
    if not _powers or len(_powers[0]) <= n:
        size = max(n + 1, STRETCH + 1)
        up = np.full(size, _ODD, dtype=np.uint64)
        down = np.full(size, _INVERSE, dtype=np.uint64)
        up[0] = down[0] = np.uint64(1)
        _powers[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _powers[0], _powers[1]


@dataclass
class Words:
    """The words of consecutive rows of a column.

    ``row`` is the first row; text ``i`` has the words ``at[i]:at[i + 1]``;
    ``hashes``, ``start`` and ``end`` (bytes inside the text) are per word.
    """

    row: int
    at: np.ndarray
    hashes: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def __len__(self) -> int:
        return len(self.at) - 1


def some_rows(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in smaller ones, so that what is made of them stays small."""
    for batch in batches:
        for low in range(0, len(batch), rows):
            yield batch.slice(low, rows)


def column_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offset of each text; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held is not None else np.zeros(0, dtype=np.uint8)
    return data, offsets


def _bounds(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of ``data``, no word reaching over a cut."""
    inside = ~_SPACE[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    inner = cuts[(cuts > 0) & (cuts < len(data))]
    before[inner] = False
    after[inner - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def _hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool) -> np.ndarray:
    """64 bits of each word: its 8-byte pieces are mixed in one after the other, the
    length last.  No sum of pieces is taken, so no two words cancel out by their form."""
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[: len(data)] = _LOWER[data] if lower else data
    pieces = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    size = end - start
    hashes = mix((pieces[start] & _KEEP[np.minimum(size, 8)]) + _ODD)
    more, done = np.flatnonzero(size > 8), 8
    while len(more):
        if done >= LONG_WORD:
            for i in more.tolist():
                rest = hashlib.blake2b(padded[start[i] + done : end[i]].tobytes(), digest_size=8).digest()
                hashes[i] ^= np.frombuffer(rest, dtype="<u8")[0]
            hashes[more] = mix(hashes[more])
            break
        piece = pieces[start[more] + done] & _KEEP[np.minimum(size[more] - done, 8)]
        hashes[more] = mix((hashes[more] ^ piece) + _ODD)
        done += 8
        more = more[size[more] > done]
    return mix(hashes ^ (size.astype(np.uint64) * _ODD))


def _long_text(row: int, data: np.ndarray, lower: bool) -> Words:
    parts, base = [], 0
    while base < len(data):
        stop = min(len(data), base + STRETCH)
        if stop < len(data):
            blanks = np.flatnonzero(_SPACE[data[base:stop]])
            if len(blanks):
                stop = base + int(blanks[-1]) + 1
            else:  # one word longer than a stretch: take it whole
                while stop < len(data) and not _SPACE[data[stop]]:
                    step = data[stop : stop + STRETCH]
                    blank = np.flatnonzero(_SPACE[step])
                    stop += int(blank[0]) if len(blank) else len(step)
        piece = data[base:stop]
        start, end = _bounds(piece, np.zeros(0, dtype=np.int64))
        parts.append((_hash_spans(piece, start, end, lower), start + base, end + base))
        base = stop
    hashes, start, end = (np.concatenate([p[k] for p in parts]) for k in range(3))
    return Words(row, np.array([0, len(hashes)]), hashes, start, end)


def scan(column: pa.Array | pa.ChunkedArray, lower: bool = True) -> Iterator[Words]:
    """The words of all rows, in groups of rows of about a stretch of bytes each."""
    data, offsets = column_bytes(column)
    rows, row = len(offsets) - 1, 0
    while row < rows:
        last = int(np.searchsorted(offsets, offsets[row] + STRETCH, side="right")) - 1
        last = min(max(last, row + 1), rows)
        low, high = int(offsets[row]), int(offsets[last])
        piece = data[low:high]
        if last == row + 1 and len(piece) > STRETCH:
            yield _long_text(row, piece, lower)
        elif len(piece) == 0:
            none = np.zeros(0, dtype=np.int64)
            yield Words(row, np.zeros(last - row + 1, dtype=np.int64), none.astype(np.uint64), none, none)
        else:
            cuts = offsets[row : last + 1] - low
            start, end = _bounds(piece, cuts)
            at = np.searchsorted(start, cuts)
            hashes = _hash_spans(piece, start, end, lower)
            shift = np.repeat(cuts[:-1], np.diff(at))
            yield Words(row, at, hashes, start - shift, end - shift)
        row = last


def grams(hashes: np.ndarray, size: int, seed: int = 2) -> np.ndarray:
    """A hash of each run of ``size`` words; empty when there are fewer."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for j, c in enumerate(constants(seed, size)):
        total += hashes[j : j + n] * c
    return mix(total)


def shingle_sets(words: Words, size: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text.

    A text with fewer than ``size`` words, but one at least, has its whole word
    sequence as its only shingle; a text without words has the empty set.
    """
    every = grams(words.hashes, size)
    short = constants(3, size)
    for low, high in zip(words.at[:-1].tolist(), words.at[1:].tolist()):
        n = high - low
        if n >= size:
            yield np.unique(every[low : high - size + 1])
        elif n:
            yield mix((words.hashes[low:high] * short[:n]).sum(keepdims=True) + short[n : n + 1])
        else:
            yield np.zeros(0, dtype=np.uint64)
