"""Repeated passages, from a sparse suffix array at content-selected places.

A passage of 50 words or more that stands in two places is found exactly, to the
word, without keeping every suffix of the corpus:

1. In each stretch of 50 words the 10-word seed with the smallest hash is chosen
   by its content alone: about one place in 21; equal stretches choose the same one.
   Only suffixes at chosen places are retained, and of these only those whose seed
   is chosen at another place too.
2. A retained suffix carries the words that its stretches cover: those in front of
   the place and those from it on.  Suffixes are dealt by seed and sorted by the
   words from the place on.
3. Sorted neighbours are compared: how many words they share is the depth to which a
   match goes on to the right.  A suffix whose better neighbour leaves no stretch of
   50 words falls out.
4. The others are extended to the left, one word at a time.  With each word the match
   may be one word shorter to the right, so suffixes that share that many words (runs
   of neighbours) and the same words in front are in one match.  All of a run are
   looked at, not the nearest neighbour alone, so a third text hides nothing.
5. What is matched is joined to maximal spans.

A seed of very many places would make one task read them all.  Its suffixes stay where
they are, in blocks: each of their stretches is known by a 128-bit digest of its bytes.
Digests are counted in Spark, once per block, and a block is told which of its digests
are matched.

Texts that are equal as a whole are compared once: only the first of them, by
doc_id, takes part, with the weight of all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bytesift.llm import blobs
from bytesift.llm.store import WORD, stored
from bytesift.llm.text import column_bytes, grams, scan, some_rows

MIN_WORDS = 50
SEED_WORDS = 10

# A seed of more places than the larger of these, the second being a share of all
# places, is taken apart; so at most HOT_SHARE seeds are such.
HOT_PLACES = 1 << 12
HOT_SHARE = 1 << 18
# Retained suffixes that are compared together, and that are handed on together.  Those
# that are compared take some 4 KB each of a worker's memory, which it does not give back.
SUFFIXES_TOGETHER = 1 << 13
ROWS_TOGETHER = 1 << 12
# Retained suffixes in a block.
BLOCK = 1 << 13


def minimisers(hashes: np.ndarray, size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """For each stretch of ``size`` words the place of its chosen seed, and all seeds."""
    seeds = grams(hashes, seed, 11)
    width = size - seed + 1
    if len(seeds) < width:
        return np.zeros(0, dtype=np.int64), seeds
    parts = []
    for low in range(0, len(seeds) - width + 1, 1 << 16):  # bounds the helper arrays
        view = np.lib.stride_tricks.sliding_window_view(seeds[low : low + (1 << 16) + width - 1], width)
        parts.append(view.argmin(axis=1) + np.arange(low, low + len(view)))
    return np.concatenate(parts), seeds


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, bytes, word hashes, starts, ends) of each text, case kept."""
    data, offsets = column_bytes(batch["text"])
    for words in scan(batch["text"], lower=False):
        for i in range(len(words)):
            at = slice(words.at[i], words.at[i + 1])
            row = words.row + i
            yield row, data[offsets[row] : offsets[row + 1]], words.hashes[at], words.start[at], words.end[at]


def _places(data: np.ndarray) -> np.ndarray:
    """Code points before each byte, and before the end."""
    out = np.zeros(len(data) + 1, dtype=np.int32)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def _ids(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), "text").where("doc_id IS NOT NULL")


def survey(docs: DataFrame, size: int, seed: int) -> DataFrame:
    """doc_id, sig (of the words), n_words, low and high (where the words begin and
    end, in code points) and the seeds chosen, of each text of ``size`` words."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in some_rows(batches):
            kept: list[list] = [[], [], [], [], [], []]
            ids = batch["doc_id"].to_numpy(zero_copy_only=False)
            for row, data, hashes, start, end in _texts(batch):
                if len(hashes) < size:
                    continue
                at, seeds = minimisers(hashes, size, seed)
                place = _places(data)
                sig = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
                chosen = seeds[np.unique(at)].view(np.int64)
                for column, value in zip(kept, (ids[row], sig, len(hashes), place[start[0]], place[end[-1]], chosen)):
                    column.append(value)
            types = [pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(kept, types)], ["doc_id", "sig", "n_words", "low", "high", "seeds"]
            )

    return _ids(docs).mapInArrow(
        read, "doc_id BIGINT, sig BINARY, n_words BIGINT, low INT, high INT, seeds ARRAY<BIGINT>"
    )


SUFFIXES = (
    "doc_id BIGINT, key BIGINT, hot BOOLEAN, pos INT, low_pos INT, before BINARY, after BINARY, lows ARRAY<INT>, highs ARRAY<INT>"
)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    cuts = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(x) for x in parts], out=cuts[1:])
    return pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(parts).astype(np.int32)))


def retained_suffixes(docs: DataFrame, repeated: np.ndarray, hot: np.ndarray, size: int, seed: int) -> DataFrame:
    """The suffixes at chosen places whose seed may be repeated.

    Per suffix: doc_id, key (its seed), pos (its first word), low_pos (the first word of
    the first stretch that chose it), ``before`` and ``after`` (the words of its stretches
    in front of pos and from pos on, each word followed by one blank), ``lows`` and
    ``highs`` (where its stretches begin and end, in code points).  A suffix whose seed is
    in ``hot`` has the digests of its stretches, 16 bytes each, as ``after``.
    """
    context = docs.sparkSession.sparkContext
    wanted, many = context.broadcast(repeated), context.broadcast(hot)

    def places(batch: pa.RecordBatch) -> Iterator[tuple]:
        ids = batch["doc_id"].to_numpy(zero_copy_only=False)
        for row, data, hashes, start, end in _texts(batch):
            if len(hashes) < size:
                continue
            at, seeds = minimisers(hashes, size, seed)
            chosen, first = np.unique(at, return_index=True)  # the places never go back
            last = np.append(first[1:], len(at)) - 1
            good = np.flatnonzero(blobs.may_hold(wanted.value, seeds[chosen]))
            if not len(good):
                continue
            place = _places(data)
            low, high = place[start], place[end]
            joined = b" ".join(data.tobytes().split()) + b" "  # splits at the blanks of a word
            word = np.zeros(len(hashes) + 1, dtype=np.int64)
            np.cumsum(end - start + 1, out=word[1:])
            keys = seeds[chosen].view(np.int64)
            is_hot = np.isin(keys, many.value)
            for i in good.tolist():
                p, a, z = int(chosen[i]), int(first[i]), int(last[i])
                if is_hot[i]:
                    stretches = (joined[word[s] : word[s + size]] for s in range(a, z + 1))
                    before, after = b"", b"".join(hashlib.blake2b(x, digest_size=16).digest() for x in stretches)
                else:
                    before, after = joined[word[a] : word[p]], joined[word[p] : word[z + size]]
                yield ids[row], keys[i], is_hot[i], p, a, before, after, low[a : z + 1], high[a + size - 1 : z + size]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        names = ["doc_id", "key", "hot", "pos", "low_pos", "before", "after", "lows", "highs"]
        for batch in some_rows(batches, 128):
            made = places(batch)
            while rows := list(islice(made, ROWS_TOGETHER)):
                columns = list(zip(*rows))
                flat = [pa.array(c, t) for c, t in zip(columns, types)]
                yield pa.RecordBatch.from_arrays([*flat, _lists(columns[7]), _lists(columns[8])], names)

    return _ids(docs).mapInArrow(read, SUFFIXES)


def _numbers(before: pa.Array, after: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the words of both columns, equal for equal bytes, and where each row's begin."""
    lists = [pc.split_pattern(c.cast(pa.large_binary()), b" ") for c in (before, after)]
    flat = [x.flatten() for x in lists]
    known = pa.concat_arrays(flat).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    cuts = [x.offsets.to_numpy() - x.offsets[0].as_py() for x in lists]
    return known[: len(flat[0])], cuts[0], known[len(flat[0]) :], cuts[1]


def _matrix(values: np.ndarray, begin: np.ndarray, step: int, count: np.ndarray, width: int) -> np.ndarray:
    """Row i: ``count[i]`` values from ``begin[i]`` on in steps of 1 or -1, then -1."""
    at = np.arange(width)
    inside = at < count[:, None]
    out = np.full((len(begin), width), -1, dtype=np.int32)
    out[inside] = values[(begin[:, None] + step * at)[inside]]
    return out


def matched_stretches(
    key: np.ndarray, rank: np.ndarray, copies: np.ndarray, before: np.ndarray, n_before: np.ndarray,
    after: np.ndarray, n_after: np.ndarray, size: int,
) -> np.ndarray:
    """For each suffix and each number of words l in front of it: whether the stretch of
    ``size`` words that begins there is matched.  0: no; 1: yes, and another comes first;
    2: yes, and it is the first.

    Suffixes are sorted by (key, after).  ``after`` and ``before`` are their words from
    the place on and, nearest first, in front of it, as rows of numbers filled with -1.
    """
    n, most = len(key), before.shape[1]
    shared = np.zeros(n + 1, dtype=np.int64)  # words shared with the suffix before
    if n > 1:
        equal = (after[1:] == after[:-1]) & (after[1:] >= 0)
        deep = np.where(equal.all(axis=1), after.shape[1], equal.argmin(axis=1))
        shared[1:n] = np.where(key[1:] == key[:-1], deep, 0)
    deepest = np.maximum(shared[:n], shared[1:])
    alone = copies == 1
    # the stretches that chose this place begin between these numbers of words in front
    least, state = size - n_after, np.zeros((n, most + 1), dtype=np.int8)
    left = np.zeros(n, dtype=np.int64)
    for l in range(most + 1):
        if l:
            left = np.unique(left * (int(before.max(initial=0)) + 2) + before[:, l - 1] + 1, return_inverse=True)[1]
        mine = (least <= l) & (l <= n_before)
        met = np.flatnonzero(mine & ((deepest >= size - l) | ~alone))
        if not len(met):
            continue
        run = np.cumsum(shared[:n] < size - l)
        group = np.unique(run[met] * n + left[met], return_inverse=True)[1]
        times = np.bincount(group, weights=copies[met])
        first = np.full(len(times), np.iinfo(np.int64).max)
        np.minimum.at(first, group, rank[met])
        state[met, l] = np.where(times[group] > 1, 1 + (rank[met] == first[group]), 0)
    return state


RANGES = "doc_id BIGINT, pos INT, to INT, first BOOLEAN, low INT, high INT"


def _compare(size: int, seed: int):
    """Sorted retained suffixes to ranges of matched stretches."""
    names = ["doc_id", "pos", "to", "first", "low", "high"]

    def made(table: pa.Table) -> pa.RecordBatch | None:
        column = {c: table[c].combine_chunks() for c in table.column_names}
        key, doc, pos, low_pos, copies = (column[c].to_numpy() for c in ("key", "doc_id", "pos", "low_pos", "copies"))
        words_b, cut_b, words_a, cut_a = _numbers(column["before"], column["after"])
        # the blank after the last word makes an empty one
        n_before, n_after = pos - low_pos, np.diff(cut_a) - 1
        before = _matrix(words_b, cut_b[:-1] + n_before - 1, -1, n_before, size - seed)
        after = _matrix(words_a, cut_a[:-1], 1, n_after, size)
        order = np.lexsort((pos, doc))
        new = np.concatenate([[0], (np.diff(doc[order]) != 0) | (np.diff(pos[order]) != 0)])
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.cumsum(new)
        state = matched_stretches(key, rank, copies, before, n_before, after, n_after, size)
        # from the first stretch to the last, with an empty one as border
        wide = np.zeros((len(key), state.shape[1] + 1), dtype=np.int8)
        wide[:, :-1] = state[:, ::-1]
        flat = np.concatenate([[0], wide.ravel()])
        edge = np.flatnonzero(np.diff(flat))
        begin = edge[flat[edge + 1] != 0]
        if not len(begin):
            return None
        stop = edge[np.searchsorted(edge, begin, side="right")]
        i, width = begin // wide.shape[1], wide.shape[1]
        s, e = (pos[i] - (state.shape[1] - 1) + x % width for x in (begin, stop - 1))
        lists = [(column[c].offsets.to_numpy(), column[c].values.to_numpy(zero_copy_only=False)) for c in ("lows", "highs")]
        low, high = (v[o[i] + x - low_pos[i]] for (o, v), x in zip(lists, (s, e)))
        values = (doc[i], s.astype(np.int32), e.astype(np.int32), wide.ravel()[begin] == 2, low, high)
        return pa.RecordBatch.from_arrays([pa.array(v) for v in values], names)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            if sum(map(len, held)) < SUFFIXES_TOGETHER or held[0]["key"][0] == batch["key"][-1]:
                continue
            keys = np.concatenate([x["key"].to_numpy() for x in held])
            cut = int(np.searchsorted(keys, keys[-1]))  # the last seed may go on
            together = pa.Table.from_batches(held)
            if cut and (found := made(together.slice(0, cut))):
                yield found
            held = together.slice(cut).combine_chunks().to_batches()
        if held and (found := made(pa.Table.from_batches(held))):
            yield found

    return compare


def _islands(pos: np.ndarray, to: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of ranges of stretches without a gap of words."""
    cut = np.flatnonzero(pos[1:] - np.maximum.accumulate(to)[:-1] > size)
    return np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(pos) - 1]])


def _joiner(size: int):
    """Sorted ranges of stretches of a document to spans."""
    names = ["doc_id", "pos", "to", "first", "low", "high"]

    def spans(doc: int, pos: np.ndarray, to: np.ndarray, first: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple]:
        again = np.flatnonzero(~first)
        drop_from, drop_to = _islands(pos[again], to[again], size) if len(again) else (again, again)
        drop_from, drop_to = again[drop_from], again[drop_to]
        for i, j in zip(*_islands(pos, to, size)):
            mine = (drop_from >= i) & (drop_to <= j)
            drops = [{"low": int(low[a]), "high": int(high[b])} for a, b in zip(drop_from[mine], drop_to[mine])]
            dropped = int((to[drop_to[mine]] + size - pos[drop_from[mine]]).sum())
            yield doc, int(pos[i]), int(to[j] + size - pos[i]), int(low[i]), int(high[j]), dropped, drops

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        schema = pa.schema(
            [
                ("doc_id", pa.int64()), ("start_word", pa.int64()), ("n_words", pa.int64()), ("start_char", pa.int64()),
                ("end_char", pa.int64()), ("n_dropped", pa.int64()),
                ("drops", pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))),
            ]
        )

        def made(columns: list[np.ndarray]) -> pa.RecordBatch:
            rows = []
            edges = np.flatnonzero(np.diff(columns[0])) + 1
            for part in zip(*[np.split(c, edges) for c in columns]):
                rows += spans(int(part[0][0]), *part[1:])
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for batch in batches:
            new = [batch[c].to_numpy(zero_copy_only=False) for c in names]
            if not len(new[0]):
                continue
            if held is not None:
                new = [np.concatenate([h, n]) for h, n in zip(held, new)]
            cut = int(np.searchsorted(new[0], new[0][-1]))  # the last document may go on
            if cut:
                yield made([c[:cut] for c in new])
            held = [c[cut:] for c in new]
        if held is not None:
            yield made(held)

    return join


SPANS = (
    "doc_id BIGINT, start_word BIGINT, n_words BIGINT, start_char BIGINT, end_char BIGINT, n_dropped BIGINT,"
    " drops ARRAY<STRUCT<low: BIGINT, high: BIGINT>>"
)


def _digests(after: pa.Array) -> pa.Array:
    """The digests of all suffixes, one after the other."""
    joined = b"".join(after.to_pylist())
    return pa.Array.from_buffers(pa.binary(16), len(joined) // 16, [None, pa.py_buffer(joined)])


def _each_stretch(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """For each stretch of all suffixes its suffix (row of the table) and its first word."""
    low_pos, count = table["low_pos"].to_numpy(), pc.list_value_length(table["lows"]).to_numpy()
    row = np.repeat(np.arange(len(count)), count)
    return row, low_pos[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)


def _different(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per different stretch of a block: how many there are, and the first place."""
    def made(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        row, at = _each_stretch(table)
        doc = table["doc_id"].to_numpy()[row]
        known = _digests(table["after"].combine_chunks()).dictionary_encode()
        code = known.indices.to_numpy()
        order = np.lexsort((at, doc, code))
        first = order[np.flatnonzero(np.diff(code[order], prepend=-1))]
        n = np.bincount(code, weights=table["copies"].to_numpy()[row]).astype(np.int64)
        block = np.full(len(n), held[0]["block"][0].as_py())
        values = (block, known.dictionary.cast(pa.binary()), n, doc[first], at[first].astype(np.int32))
        return pa.RecordBatch.from_arrays([pa.array(v) for v in values], ["block", "known", "n", "doc", "at"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        # blocks follow each other in their files
        cuts = np.flatnonzero(np.diff(batch["block"].to_numpy())) + 1
        for low, high in zip([0, *cuts], [*cuts, len(batch)]):
            part = batch.slice(low, high - low)
            if held and len(part) and held[0]["block"][0] != part["block"][0]:
                yield made(held)
                held = []
            if len(part):
                held.append(part)
    if held:
        yield made(held)


def _told(suffixes: pa.Table, matched: pa.Table) -> pa.Table:
    """The ranges of matched stretches of a block, whose matched digests are given with their first places."""
    row, at = _each_stretch(suffixes)
    wanted = matched["known"].combine_chunks().cast(pa.binary(16))
    met = pc.index_in(_digests(suffixes["after"].combine_chunks()), wanted).fill_null(-1).to_numpy()
    doc = suffixes["doc_id"].to_numpy()
    best_doc, best_at = (np.append(matched[c].to_numpy(), -1) for c in ("doc", "at"))
    state = np.where(met < 0, 0, 1 + ((best_doc[met] == doc[row]) & (best_at[met] == at)))
    # a range goes on over the suffixes of its document that follow each other
    new = np.append(True, (np.diff(doc[row]) != 0) | (np.diff(at) != 1) | (np.diff(state) != 0))
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(row)) - 1
    begin, end = begin[state[begin] > 0], end[state[begin] > 0]
    low, high = (pc.list_flatten(suffixes[c]).to_numpy() for c in ("lows", "highs"))
    values = (doc[row[begin]], at[begin].astype(np.int32), at[end].astype(np.int32), state[begin] == 2, low[begin], high[end])
    return pa.table([pa.array(v) for v in values], ["doc_id", "pos", "to", "first", "low", "high"])


def _counted_stretches(suffixes: DataFrame, most: int) -> DataFrame:
    """The ranges of hot seeds.  ``most`` is at least the number of stretches.

    A block has one row for each of its different stretches, and what is told to a block
    is as much at most.  Stretches of very many blocks get their count by a broadcast; at
    most HOT_SHARE stretches are such."""
    rows = suffixes.select("block", "doc_id", "copies", "low_pos", "after", "lows")
    rows = stored(rows.mapInArrow(_different, "block BIGINT, known BINARY, n BIGINT, doc BIGINT, at INT"), "stretches")
    best = F.min(F.struct("doc", "at")).alias("best")
    equal = rows.groupBy("known").agg(F.sum("n").alias("n"), F.count("*").alias("rows"), best)
    equal = stored(equal.where("n > 1").select("known", "rows", "best"), "counts")
    common = F.col("rows") > max(HOT_PLACES, most // HOT_SHARE)
    many, few = F.broadcast(equal.where(common)), equal.where(~common)
    asked = rows.select("block", "known")
    met = asked.join(many, "known").unionByName(asked.join(many, "known", "left_anti").join(few, "known"))
    told = met.select("block", "known", "best.doc", "best.at").groupBy("block")
    whole = suffixes.select("block", "doc_id", "low_pos", "after", "lows", "highs").groupBy("block")
    return whole.cogroup(told).applyInArrow(_told, RANGES)


def repeated_spans(docs: DataFrame, size: int = MIN_WORDS, seed: int = SEED_WORDS) -> DataFrame:
    """The maximal spans of ``docs(doc_id, text)`` made of repeated stretches of
    ``size`` words or more, in one document or in several.

    Per span: doc_id, start_word, n_words, start_char and end_char (code points),
    n_dropped words and ``drops``: the parts (code points) of which an occurrence
    comes earlier, by (doc_id, place).  Words are compared byte for byte (those of
    a hot seed by 128-bit digests of their bytes); white space between them is not
    compared.  A text that is NULL, empty or shorter than ``size`` words has no span.  Rows with a NULL doc_id are left out; rows with
    an equal doc_id and text are one document.  Other columns are not looked at.
    """
    known = stored(survey(docs, size, seed), "survey")
    classes = known.groupBy("sig").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    several = stored(classes.where("copies > 1"), "classes")
    whole = known.join(several, "sig").where("doc_id <> first")
    left_out = stored(whole.select("doc_id", "n_words", "low", "high"), "copies")
    copies = several.select(F.col("first").alias("doc_id"), "copies")

    def weighed(rows: DataFrame) -> DataFrame:
        firsts = rows.join(left_out.select("doc_id"), "doc_id", "left_anti")
        return firsts.join(copies, "doc_id", "left").withColumn("copies", F.coalesce("copies", F.lit(1)))

    seeds = weighed(known.select("doc_id", "seeds")).select(F.explode("seeds").alias("seed"), "copies")
    counted = seeds.groupBy("seed").agg(F.sum("copies").alias("n"), F.count("*").alias("places")).where("n > 1")
    repeated = stored(counted.select("seed", "places"), "seeds")
    members, total = repeated.agg(F.count("*"), F.coalesce(F.sum("places"), F.lit(0))).first()
    hot = repeated.where(F.col("places") > max(HOT_PLACES, total // HOT_SHARE)).select("seed").toArrow()["seed"].to_numpy()
    suffixes = retained_suffixes(docs, blobs.bloom(repeated.select("seed"), members), hot, size, seed)
    block = F.expr(f"monotonically_increasing_id() DIV {BLOCK}")
    suffixes = stored(weighed(suffixes).withColumn("block", block), "suffixes")

    dealt = suffixes.where("NOT hot").drop("block").repartition("key").sortWithinPartitions("key", "after")
    ranges = dealt.mapInArrow(_compare(size, seed), RANGES)
    if len(hot):
        ranges = ranges.unionByName(_counted_stretches(suffixes.where("hot"), size * total))
    spans = ranges.repartition("doc_id").sortWithinPartitions("doc_id", "pos").mapInArrow(_joiner(size), SPANS)
    again = left_out.selectExpr(
        "doc_id", "0L AS start_word", "n_words", "CAST(low AS BIGINT) AS start_char", "CAST(high AS BIGINT) AS end_char",
        "n_words AS n_dropped",
        "array(named_struct('low', CAST(low AS BIGINT), 'high', CAST(high AS BIGINT))) AS drops",
    )
    return spans.unionByName(again)


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every repeated passage cut out of all texts but the first.

    A document that has no word left is left out; ``n_chars``, where there is one,
    is counted anew.  Documents without repeats come out as they were.
    """
    cuts = repeated_spans(docs, **options).where("n_dropped > 0").groupBy(F.col("doc_id").alias("_doc")).agg(
        F.array_sort(F.flatten(F.collect_list("drops"))).alias("_drops")
    )
    joined = docs.select(F.struct("*").alias("_row"), "doc_id", "text").join(cuts, F.col("doc_id") == F.col("_doc"), "left")
    lows = "concat(array(0L), transform(_drops, d -> d.high))"
    highs = "concat(transform(_drops, d -> d.low), array(CAST(char_length(text) AS BIGINT)))"
    kept = F.expr(
        f"array_join(zip_with({lows}, {highs}, (l, h) -> substring(text, int(l) + 1, greatest(0, int(h - l)))), '')"
    )
    made = {"text": F.when(F.col("_drops").isNull(), F.col("text")).otherwise(kept)}
    out = joined.withColumn("_text", made["text"]).where(F.col("_drops").isNull() | F.col("_text").rlike(WORD))
    made = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        counted = F.char_length("_text").cast(docs.schema["n_chars"].dataType)
        made["n_chars"] = F.when(F.col("_drops").isNull(), F.col("_row.n_chars")).otherwise(counted)
    return out.select(*[made.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])
