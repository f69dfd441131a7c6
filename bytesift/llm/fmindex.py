"""Words copied from earlier documents, found with an FM-index per shard.

1. A window of 13 words is known by the 6-word seed with the smallest hash in it, so
   equal windows, wherever they stand, choose the same seed.  Windows whose seed no
   other document has cannot be copies; the others go, in stretches of windows with one
   seed, to the shard of that seed.  Equal stretches are made one, in their task and
   again in the shard, with the smallest and the largest doc_id that has them.
2. A shard keeps its stretches as an FM-index: word numbers under the Burrows-Wheeler
   transform, in a wavelet tree of packed bits with counts.
3. The stretches are streamed through it.  Backward search takes one word more to the
   left for all places at once; a place falls out when its match stands nowhere else,
   and the words matched until then are its matching statistic.  What reaches the
   threshold is an interval of rows, and the smallest doc_id of these rows tells for
   which documents it is a copy.
4. Documents take what their stretches were told by the digest of the stretch.

A seed that very many documents have sends its windows to shards by their own hash, one
by one, so no shard holds more than a bounded part of the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bytesift.llm import blobs
from bytesift.llm.store import stored
from bytesift.llm.text import Words, column_bytes, grams, mix, scan, some_rows

WINDOW = 13
SEED_WORDS = 6

# Words that one shard is meant to hold, and places searched at once.
SHARD_WORDS = 1 << 18
PLACES_TOGETHER = 1 << 16
# A seed of more documents than the larger of these, the second being a share of all
# places, has its windows dealt one by one; so at most HOT_SHARE seeds are such.
HOT_DOCUMENTS = 1 << 12
HOT_SHARE = 1 << 16
# Distinct stretches that a task holds to make equal ones one.
STRETCHES_TOGETHER = 1 << 16


class WaveletTree:
    """A sequence of numbers below ``sigma`` as one packed row of bits per level."""

    def __init__(self, values: np.ndarray, sigma: int):
        self.depth = max(1, int(sigma - 1).bit_length())
        self.starts = np.zeros((1 << self.depth) + 1, dtype=np.int64)  # of each number, in order
        np.cumsum(np.bincount(values, minlength=1 << self.depth), out=self.starts[1:])
        self.bits: list[np.ndarray] = []
        self.ones: list[np.ndarray] = []
        self.node_ones: list[np.ndarray] = []  # in front of each node
        for level in range(self.depth):
            bit = ((values >> (self.depth - 1 - level)) & 1).astype(np.uint8)
            packed = np.packbits(bit, bitorder="little")
            words = np.zeros(len(values) // 64 + 1, dtype="<u8")
            words.view(np.uint8)[: len(packed)] = packed
            before = np.zeros(len(words), dtype=np.int32)
            np.cumsum(np.bitwise_count(words[:-1]), out=before[1:])
            self.bits.append(words)
            self.ones.append(before)
            at_nodes = self.starts[: 1 << self.depth : 1 << (self.depth - level)]
            self.node_ones.append(self._ones(level, at_nodes))
            child = values >> (self.depth - 1 - level)  # the children, left to right; short keys sort fast
            values = values[np.argsort(child.astype(np.uint16) if level < 16 else child, kind="stable")]

    def _ones(self, level: int, upto: np.ndarray) -> np.ndarray:
        word, rest = upto >> 6, (upto & 63).astype(np.uint64)
        held = self.bits[level][word] & ((np.uint64(1) << rest) - np.uint64(1))
        return self.ones[level][word] + np.bitwise_count(held)

    def rank(self, value: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often each ``value`` stands in front of place ``upto``."""
        at = upto.astype(np.int64)
        for level in range(self.depth):
            under = self.depth - 1 - level
            node = value >> (under + 1)
            ones = self._ones(level, self.starts[node << (under + 1)] + at) - self.node_ones[level][node]
            at = np.where((value >> under) & 1 == 1, ones, at - ones)
        return at


def suffix_order(numbers: np.ndarray) -> np.ndarray:
    """The starts of all suffixes in their order, by doubling."""
    n = len(numbers)
    ranks, width = np.unique(numbers, return_inverse=True)[1].reshape(-1).astype(np.int64), 1
    while True:
        key = ranks * (n + 1)
        if width < n:
            key[:-width] += ranks[width:] + 1
        order = np.argsort(key)
        step = np.zeros(n, dtype=np.int64)
        step[1:] = np.diff(key[order]) != 0
        ranks[order] = np.cumsum(step)
        if n == 0 or ranks[order[-1]] == n - 1:
            return order
        width *= 2


class FmIndex:
    """Backward search over ``numbers``, which are 1 or more; 0 ends a stretch."""

    def __init__(self, numbers: np.ndarray):
        self.order = suffix_order(numbers)
        sigma = int(numbers.max()) + 1 if len(numbers) else 1
        self.tree = WaveletTree(numbers[self.order - 1], sigma)  # the number in front; of the first, the last
        self.first = self.tree.starts

    def matching_statistics(
        self, text: np.ndarray, ends: np.ndarray, limit: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each place behind a word, the words (at most ``limit``) of the longest
        match that ends there and stands in two rows or more, and its rows low..high-1.

        ``text`` is made of numbers of the index and holds ``limit`` words before each end.
        """
        known = np.zeros(len(ends), dtype=np.int64)
        low, high = np.zeros(len(ends), dtype=np.int64), np.full(len(ends), len(self.order), dtype=np.int64)
        alive = np.arange(len(ends))
        for k in range(limit):
            word = text[ends[alive] - 1 - k]
            if k:
                below = self.first[word]
                both = self.tree.rank(np.concatenate([word, word]), np.concatenate([low[alive], high[alive]]))
                new = below + both[: len(word)], below + both[len(word) :]
            else:
                new = self.first[word], self.first[word + 1]
            again = new[1] - new[0] > 1
            alive = alive[again]
            low[alive], high[alive] = new[0][again], new[1][again]
            known[alive] = k + 1
        return known, low, high


def copied_from(words: np.ndarray, lengths: np.ndarray, least: np.ndarray, size: int) -> np.ndarray:
    """For each window of ``size`` words of each stretch, in order, the smallest number in
    ``least`` (one per stretch) of all stretches that hold the window.

    ``words`` are the hashes of the stretches' words one after the other.
    """
    begin = np.cumsum(lengths + 1) - lengths - 1
    of = np.repeat(np.arange(len(lengths)), lengths + 1)
    numbers = np.zeros(len(of), dtype=np.int64)
    inner = np.ones(len(of), dtype=bool)
    inner[begin + lengths] = False
    numbers[inner] = np.unique(words, return_inverse=True)[1].reshape(-1) + 1
    index = FmIndex(numbers)
    held = least[of[index.order]]  # by row
    windows = lengths - size + 1
    ends = np.repeat(begin + size - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
    out = np.repeat(least, windows)
    for at in range(0, len(ends), PLACES_TOGETHER):
        part = ends[at : at + PLACES_TOGETHER]
        known, low, high = index.matching_statistics(numbers, part, size)
        good = np.flatnonzero(known == size)
        if len(good):
            # rows of equal windows are one interval, and intervals of one length do not overlap
            rows, one, which = np.unique(low[good], return_index=True, return_inverse=True)
            edges = np.stack([rows, high[good][one]], axis=1).reshape(-1)
            if edges[-1] == len(held):
                edges = edges[:-1]
            out[at + good] = np.minimum.reduceat(held, edges)[::2][which.reshape(-1)]
    return out


def _tag(hashes: np.ndarray) -> int:
    """64 bits of a text's words; tells texts apart that share a doc_id."""
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def _found_in(ordered: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), dtype=bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _distinct(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal keys together, and where in it a new key begins."""
    by = np.lexsort(keys[::-1])
    new = np.ones(len(by), dtype=bool)
    new[1:] = False
    for key in keys:
        new[1:] |= key[by][1:] != key[by][:-1]
    return by, np.flatnonzero(new)


class Windows:
    """The windows of consecutive texts: of each that lies in one text its first word
    (``at``), its text (``text``), and the place and hash of the seed chosen."""

    def __init__(self, words: Words, size: int, seed: int):
        self.words, self.size = words, size
        text = np.repeat(np.arange(len(words)), np.diff(words.at))
        n = max(0, len(text) - size + 1)
        seeds = grams(words.hashes, seed, 11)
        best, place = seeds[:n].copy(), np.zeros(n, dtype=np.int64)
        for j in range(1, size - seed + 1):
            less = seeds[j : j + n] < best
            np.copyto(best, seeds[j : j + n], where=less)
            place[less] = j
        self.at = np.flatnonzero(text[:n] == text[size - 1 :]) if n else np.zeros(0, dtype=np.int64)
        self.text, self.place, self.seed = text[self.at], (place[self.at] + self.at), best[self.at]

    def tag(self, text: int) -> int:
        return _tag(self.words.hashes[self.words.at[text] : self.words.at[text + 1]])


def seeds_of(docs: DataFrame, size: int, seed: int) -> DataFrame:
    """One row per document and chosen seed."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in some_rows(batches):
            ids = batch["doc_id"].to_numpy(zero_copy_only=False)
            for words in scan(batch["text"], lower=False):
                w = Windows(words, size, seed)
                by, new = _distinct(w.text, w.seed)
                once = by[new]
                columns = pa.array(ids[words.row + w.text[once]], pa.int64()), pa.array(w.seed[once].view(np.int64))
                yield pa.RecordBatch.from_arrays(list(columns), ["doc_id", "seed"])

    return docs.mapInArrow(read, "doc_id BIGINT, seed BIGINT")


@dataclass
class Stretches:
    """How texts are cut: windows in a row with one seed that others may have too.

    ``repeated`` is a Bloom filter of seeds, or None where each row has its own list;
    ``hot`` are the seeds, in order, whose windows go alone.
    """

    repeated: np.ndarray | None
    hot: np.ndarray
    size: int
    seed: int

    def of(self, words: Words, lists: pa.Array | None) -> tuple[Windows, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The windows, the first and the last of each stretch, and two hashes that name
        the stretch: of its first window, and of its last one and its length."""
        w = Windows(words, self.size, self.seed)
        if self.repeated is not None:
            wanted = blobs.may_hold(self.repeated, w.seed)
        else:
            wanted = np.zeros(len(w.at), dtype=bool)
            for text in range(len(words)):
                part = slice(*np.searchsorted(w.text, [text, text + 1]))
                wanted[part] = _found_in(np.sort(lists[words.row + text].values.to_numpy().view(np.uint64)), w.seed[part])
        mine = np.flatnonzero(wanted)
        new = np.ones(len(mine), dtype=bool)
        new[1:] = (np.diff(w.at[mine]) > 1) | (np.diff(w.place[mine]) != 0) | (np.diff(w.text[mine]) != 0)
        new |= _found_in(self.hot, w.seed[mine])
        first = np.flatnonzero(new)
        last = mine[np.append(first[1:], len(mine)) - 1] if len(mine) else mine
        first = mine[first]
        one, other = (grams(words.hashes, self.size, k) for k in (17, 19))
        length = (w.at[last] - w.at[first]).astype(np.uint64)
        return w, first, last, one[w.at[first]], mix(other[w.at[last]] + length)


def contents(docs: DataFrame, cut: Stretches, shards: int) -> DataFrame:
    """shard, one, other (the name), least and most (doc_id) and content (word hashes) of
    the stretches; equal ones of a task are made one."""
    shared = docs.sparkSession.sparkContext.broadcast(cut)
    names = ["shard", "one", "other", "least", "most", "content"]

    def made(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        shard, one, other, doc, lengths, words = (np.concatenate(c) for c in zip(*held))
        by, new = _distinct(one, other)
        once = by[new]
        least, most = (f.reduceat(doc[by], new) if len(by) else doc for f in (np.minimum, np.maximum))
        sizes = lengths[once]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        begin = (np.cumsum(lengths) - lengths)[once]
        taken = words[np.repeat(begin - ends[:-1], sizes) + np.arange(ends[-1])]
        content = pa.Array.from_buffers(
            pa.binary(), len(once), [None, pa.py_buffer((8 * ends).astype(np.int32)), pa.py_buffer(taken)]
        )
        columns = [pa.array(shard[once], pa.int32()), *[pa.array(k[once].view(np.int64)) for k in (one, other)]]
        return pa.RecordBatch.from_arrays([*columns, pa.array(least), pa.array(most), content], names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in some_rows(batches):
            ids = batch["doc_id"].to_numpy(zero_copy_only=False)
            lists = batch["seeds"] if "seeds" in batch.schema.names else None
            for words in scan(batch["text"], lower=False):
                w, first, last, one, other = shared.value.of(words, lists)
                if not len(first):
                    continue
                single = _found_in(shared.value.hot, w.seed[first])
                key = np.where(single, one, mix(w.seed[first]))
                lengths = w.at[last] - w.at[first] + w.size
                ends = np.cumsum(lengths)
                flat = words.hashes[np.repeat(w.at[first] - ends + lengths, lengths) + np.arange(ends[-1])]
                held.append(((key % np.uint64(shards)).astype(np.int32), one, other, ids[words.row + w.text[first]], lengths, flat))
                count += len(first)
                if count >= STRETCHES_TOGETHER:
                    yield made(held)
                    held, count = [], 0
        if held:
            yield made(held)

    return docs.mapInArrow(read, "shard INT, one BIGINT, other BIGINT, least BIGINT, most BIGINT, content BINARY")


def _searched(size: int):
    """Stretches (as of ``contents``), sorted by shard, to (one, other, sources)."""
    def made(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        one, other, least, most = (table[c].to_numpy() for c in ("one", "other", "least", "most"))
        by, new = _distinct(one, other)
        once = by[new]
        least, most = np.minimum.reduceat(least[by], new), np.maximum.reduceat(most[by], new)
        data, offsets = column_bytes(table["content"].take(pa.array(once)))
        lengths = np.diff(offsets) // 8
        words = np.frombuffer(data[offsets[0] : offsets[-1]].tobytes(), dtype=np.uint64)
        sources = copied_from(words, lengths, least, size)
        windows = lengths - size + 1
        ends = np.concatenate([[0], np.cumsum(windows)])
        kept = np.flatnonzero(np.logical_or.reduceat(sources < np.repeat(most, windows), ends[:-1]))
        lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(sources)).take(pa.array(kept))
        return pa.RecordBatch.from_arrays([pa.array(one[once][kept]), pa.array(other[once][kept]), lists], ["one", "other", "sources"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            shard = batch["shard"].to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
            for a, b in zip(edges, edges[1:]):
                if a < b:
                    if held and held[-1]["shard"][0].as_py() != shard[a]:
                        yield made(held)
                        held = []
                    held.append(batch.slice(a, b - a))
        if held:
            yield made(held)

    return search


def places(docs: DataFrame, cut: Stretches, told: np.ndarray | None) -> DataFrame:
    """one, other, doc_id, tag and pos (first word) of the stretches whose name may be in ``told``."""
    shared = docs.sparkSession.sparkContext.broadcast((cut, told))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, told = shared.value
        for batch in some_rows(batches):
            ids = batch["doc_id"].to_numpy(zero_copy_only=False)
            lists = batch["seeds"] if "seeds" in batch.schema.names else None
            for words in scan(batch["text"], lower=False):
                w, first, _, one, other = cut.of(words, lists)
                if told is not None:
                    good = blobs.may_hold(told, one ^ other)
                    first, one, other = first[good], one[good], other[good]
                texts, which = np.unique(w.text[first], return_inverse=True)
                tags = np.array([w.tag(t) for t in texts.tolist()], dtype=np.int64)
                columns = [
                    pa.array(one.view(np.int64)), pa.array(other.view(np.int64)), pa.array(ids[words.row + w.text[first]], pa.int64()),
                    pa.array(tags[which.reshape(-1)], pa.int64()), pa.array(w.at[first] - words.at[w.text[first]], pa.int32()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["one", "other", "doc_id", "tag", "pos"])

    return docs.mapInArrow(read, "one BIGINT, other BIGINT, doc_id BIGINT, tag BIGINT, pos INT")


def copied_windows(docs: DataFrame, size: int = WINDOW, seed: int = SEED_WORDS) -> DataFrame:
    """doc_id, tag and windows of the rows of ``docs(doc_id, text)`` that hold copied words.

    ``windows`` are structs (pos, copied): bit k of ``copied`` says that the window of
    ``size`` words at word pos + k also starts in a document with a smaller doc_id.
    ``tag`` is a digest of the words; rows equal in doc_id and words are one row here.
    A document is never its own source: rows that share a doc_id do not see each other,
    and rows with a NULL doc_id neither give nor lose words.
    """
    if not 1 <= seed <= size < seed + 62:
        raise ValueError("a window has its seed and up to 61 words more")
    rows = _rows(docs).where("doc_id IS NOT NULL")
    seeds = seeds_of(rows, size, seed)
    repeated = stored(seeds.groupBy("seed").agg(F.count("*").alias("n")).where("n > 1"), "seeds")
    members, total = repeated.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    above = max(HOT_DOCUMENTS, total // HOT_SHARE)
    hot = np.array([r[0] for r in repeated.where(F.col("n") > above).select("seed").collect()], dtype=np.int64)
    if blobs.fits(members):
        table = blobs.bloom(repeated.select("seed"), members)
    else:  # each text with its own list
        again = seeds.join(repeated.select("seed"), "seed").groupBy("doc_id").agg(F.collect_set("seed").alias("seeds"))
        rows, table = stored(rows.join(again, "doc_id"), "texts"), None
    cut = Stretches(table, np.sort(hot.view(np.uint64)), size, seed)

    shards = max(1, total * (2 * size - seed) // SHARD_WORDS)
    dealt = contents(rows, cut, shards).repartition("shard").sortWithinPartitions("shard")
    sources = stored(dealt.mapInArrow(_searched(size), "one BIGINT, other BIGINT, sources ARRAY<BIGINT>"), "sources")
    known = sources.count()
    told = blobs.bloom(sources.select(F.expr("one ^ other")), known) if blobs.fits(known) else None
    met = places(rows, cut, told).join(sources, ["one", "other"])
    bits = "aggregate(reverse(sources), 0L, (bits, s) -> 2L * bits + IF(s < doc_id, 1L, 0L))"
    found = met.select("doc_id", "tag", "pos", F.expr(bits).alias("copied")).where("copied <> 0")
    return found.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("pos", "copied")).alias("windows"))


def _left(words: list[bytes], copied: list[dict], hashes: np.ndarray, size: int) -> list[bytes]:
    """The words that no copied window of this text covers."""
    mark, tag = np.zeros(len(words) + 1, dtype=np.int64), _tag(hashes)
    for part in copied:
        if part["tag"] == tag:
            pos = np.array([x["pos"] for x in part["windows"]])
            bits = np.array([x["copied"] for x in part["windows"]])
            for k in range(int(bits.max()).bit_length()):
                at = pos[(bits >> k) & 1 == 1] + k
                np.add.at(mark, at, 1)
                np.add.at(mark, at + size, -1)
    return [w for w, n in zip(words, np.cumsum(mark).tolist()) if not n]


def without_copied_words(docs: DataFrame, size: int = WINDOW, seed: int = SEED_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed and kept of every row of ``docs(doc_id, text)``.

    A word is removed if a window of ``size`` words around it also starts in a document
    with a smaller doc_id, judged on the texts as given; ``kept`` has the others, joined by
    one space.  Words are compared by 64-bit hashes of their bytes, windows word for word.
    A NULL or empty text, or one without words, has 0 words and keeps the empty text; one
    of fewer than ``size`` words keeps all.  Repeated rows, and rows with a NULL doc_id,
    come out as they came in.  Other columns are not looked at.
    """
    found = stored(copied_windows(docs, size, seed), "windows")
    rows = _rows(docs)
    members = found.count()
    touched = blobs.bloom(found.select("doc_id"), members) if blobs.fits(members) else np.full(2, 255, dtype=np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(touched)

    def is_touched(batch: pa.RecordBatch) -> np.ndarray:
        ids = batch["doc_id"].fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)
        return blobs.may_hold(shared.value, ids) & batch["doc_id"].is_valid().to_numpy(zero_copy_only=False)

    def only_touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(is_touched(batch)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in some_rows(batches):
            if "copied" not in batch.schema.names:
                batch = batch.filter(pa.array(~is_touched(batch)))
            n_words, n_removed, kept = [], [], []
            for k, text in enumerate(batch["text"].cast(pa.large_binary())):
                words = (text.as_py() or b"").split()  # at the same six bytes of white space
                left = words
                if "copied" in batch.schema.names and batch["copied"][k].is_valid and words:
                    hashes = next(scan(batch["text"].slice(k, 1), lower=False)).hashes
                    left = _left(words, batch["copied"][k].as_py(), hashes, size)
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
                kept.append(b" ".join(left).decode("utf-8"))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    # only texts that may have lost words are shuffled to their windows
    per_id = found.groupBy(F.col("doc_id").alias("of")).agg(F.collect_list(F.struct("tag", "windows")).alias("copied"))
    some = rows.mapInArrow(only_touched, "doc_id BIGINT, text STRING")
    joined = some.join(per_id, some["doc_id"] == per_id["of"], "left").select("doc_id", "text", "copied")
    schema = "doc_id BIGINT, n_words BIGINT, n_removed BIGINT, kept STRING"
    return rows.mapInArrow(read, schema).unionByName(joined.mapInArrow(read, schema))
