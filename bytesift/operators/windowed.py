"""Search for many patterns at once: sampled text windows joined to anchors.

Each text is sampled with windows at multiples of a stride ``s``.  A pattern has
one anchor per residue of ``s``: a window of the pattern with its offset.  An
occurrence meets the sampling with exactly one residue, hence with exactly one
anchor, so each match comes out once and nothing has to be made distinct.

The window join uses anchor *shapes* (window hash, offset, pattern length), not
patterns: however many patterns share a window, a text window meets each shape
once.  A shape names the bytes that would have to equal a pattern, and those are
equi-joined to the patterns themselves.  So a boilerplate window shared by a
third of all patterns never pairs the text with all of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bytesift.functions import byte_length, cut, quoted
from bytesift.plans.choice import BROADCAST_BYTES, FILTER_BYTES, SALTS, Search, class_of, setting, shape_bytes
from bytesift.plans.windows import WindowClass

# Windows are generated in stretches of this many, to bound the arrays, and of
# about this many bytes, to keep offsets in range.
WINDOWS_PER_STRETCH = 1 << 14
MAX_STRETCH = 1 << 20
# Bytes of text per fetched slice in the shuffled path.
FETCH_BLOCK = 1 << 16
# Last windows that a shape keeps.
ENDS_KEPT = 64
# Bits of the bitmap per anchor, before it is rounded up to a power of two.
BITS_PER_ANCHOR = 16
# Bytes of anchor shapes that one pass over a stream takes at least.
LEAST_SLICE = 1 << 20
# Anchors up to this many are made distinct in one partition.
FEW_ANCHORS = 1 << 16

START = "_w - _j"
# The shape found at the window lies inside a text of _n bytes (differences only:
# sums would overflow near the end of the longest possible value).
INSIDE = "_w >= _j AND _m - _j <= _n - _w"
# The anchor that was met is the one that the pattern uses for this residue;
# null-safe, so that no filter on _offsets is inferred and computed again.
OWN_ANCHOR = "_offsets[_j % _ts] <=> _j"


def _is_run(offset: str) -> str:
    """True for a window of ``_p`` that repeats with a period of 1 to 4 bytes."""
    periods = [
        f"(_q >= {2 * d} AND {cut('_p', offset, f'_q - {d}')} = {cut('_p', f'{offset} + {d}', f'_q - {d}')})"
        for d in (1, 2, 3, 4)
    ]
    return f"({' OR '.join(periods)})"


def anchored(patterns: DataFrame, classes: list[WindowClass]) -> DataFrame:
    """patterns(_id, _p) with ``_m``, ``_q``, ``_s`` and ``_offsets`` added.

    ``_offsets[r]`` is the offset of the anchor for residue ``r``: the first
    window that is not a mere run (blanks, rules, repeated marks), because runs
    are what long texts have most of; the first window where all are runs.
    """
    sized = patterns.selectExpr("_id", "_p", f"{byte_length('_p')} AS _m").where("_m >= 1")
    classed = sized.selectExpr("*", f"{class_of('_m', classes)} AS _c").selectExpr(
        "_id", "_p", "_m", "_c.q AS _q", "_c.s AS _s"
    )
    varied = f"filter(sequence(r, _m - _q, _s), o -> NOT {_is_run('o')})"
    best = f"IF({_is_run('r')}, coalesce(get({varied}, 0), r), r)"
    return classed.selectExpr("*", f"transform(sequence(0, _s - 1), r -> {best}) AS _offsets")


def _shapes(anchors: DataFrame, search: Search, ends: bool = False) -> DataFrame:
    """Distinct (_h, _j, _m): window hash, its offset, length of the pattern.

    With ``ends`` also _e, the hash of the pattern's last window.
    """
    if search.stats.count * search.classes[0].stride <= FEW_ANCHORS:
        anchors = anchors.repartition(1)  # not coalesce: that would scan the source in one task
    # explode_outer: no filter on _offsets is inferred and computed again
    windows = anchors.selectExpr("_p", "_m", "_q", "_s", "explode_outer(_offsets) AS _j")
    end = [f"xxhash64(_q, _s, {cut('_p', '_m - _q', '_q')}) AS _e"] if ends else []
    return windows.selectExpr(f"xxhash64(_q, _s, {cut('_p', '_j', '_q')}) AS _h", "_j", "_m", *end).distinct()


def _ended_shapes(shapes: DataFrame) -> DataFrame:
    """(_h, _j, _m, _ends): each shape once, with the hashes of its patterns' last windows.

    A shape of more than ENDS_KEPT of them has NULL instead: any end may do.
    """
    ends = F.collect_list("_e")
    return shapes.groupBy("_h", "_j", "_m").agg(F.when(F.count("*") <= ENDS_KEPT, ends).alias("_ends"))


def _text_windows(texts: DataFrame, classes: list[WindowClass]) -> DataFrame:
    """Each text once per sampled window: adds ``_n``, ``_s``, ``_w``, ``_h``."""
    kept = [quoted(c) for c in texts.columns]
    steps = [c.stride * max(1, min(WINDOWS_PER_STRETCH, MAX_STRETCH // c.stride)) for c in classes]
    rows = ", ".join(f"({c.q}, {c.stride}, {step})" for c, step in zip(classes, steps))
    last = f"{byte_length('_b')} - _q"
    return (
        texts.selectExpr(*kept, f"inline(array({rows})) AS (_q, _s, _step)")
        .where(f"{byte_length('_b')} >= _q")
        .selectExpr("*", f"explode(sequence(0, {last}, _step)) AS _lo")
        .selectExpr("*", f"_lo + least(_step - _s, {last} - _lo) AS _hi")
        .selectExpr("*", "explode(sequence(_lo, _hi, _s)) AS _w")
        .selectExpr(
            *kept,
            f"{byte_length('_b')} AS _n",
            "_q",
            "_s",
            "_w",
            f"xxhash64(_q, _s, {cut('_b', '_w', '_q')}) AS _h",
        )
    )


def hash_positions(
    texts: DataFrame, keys: list[str], patterns: DataFrame, search: Search
) -> DataFrame:
    """keys, _id, _m, _pos of every occurrence of ``patterns`` in ``texts``.

    ``texts`` has the key columns and ``_b``; ``patterns`` has ``_id`` and ``_p``.
    """
    if not search.classes:  # no usable pattern
        id_type = patterns.schema["_id"].dataType
        return texts.where(F.lit(False)).select(
            *keys,
            F.lit(None).cast(id_type).alias("_id"),
            F.lit(0).alias("_m"),
            F.lit(0).alias("_pos"),
        )
    anchors = anchored(patterns, search.classes)
    if search.broadcast_shapes:
        return _broadcast_positions(texts, keys, anchors, search)
    if texts.isStreaming:
        return _in_passes(texts, keys, anchors, search)
    return _shuffled_positions(texts, keys, anchors, search)


def _in_passes(texts: DataFrame, keys: list[str], anchors: DataFrame, search: Search) -> DataFrame:
    """The search of a stream for more anchor shapes than may be broadcast at once.

    The shapes are dealt by their hash to slices within the bound, and each slice is
    broadcast to a pass of its own over the micro-batch.  A window's hash is in one slice,
    so each occurrence still comes out once.
    """
    spark = texts.sparkSession
    most = max(setting(spark, BROADCAST_BYTES), LEAST_SLICE)
    passes = max(1, -(-shape_bytes(search.stats, search.classes[0].stride) // most))
    found = [_broadcast_positions(texts, keys, anchors, search, (i, passes)) for i in range(passes)]
    return reduce(DataFrame.unionByName, found)


def _candidates(
    texts: DataFrame, keys: list[str], anchors: DataFrame, search: Search, of_slice: tuple[int, int] = (0, 1)
) -> DataFrame:
    """keys, _j, _ts, _pos and _p: the bytes that would have to equal a pattern.

    A window that many lengths of pattern share, such as a common prefix, meets a shape
    for each of them; only those whose last window stands where it should are cut out.
    """
    shapes = _shapes(anchors, search, ends=True)
    if of_slice[1] > 1:
        shapes = shapes.where(f"pmod(_h, {of_slice[1]}L) = {of_slice[0]}")
    end = f"xxhash64(_q, _s, {cut('_b', f'{START} + (_m - _q)', '_q')})"
    return (
        _text_windows(texts, search.classes)
        .join(F.broadcast(_ended_shapes(shapes)), "_h")
        .where(INSIDE)
        .where(f"_ends IS NULL OR array_contains(_ends, {end})")
        .selectExpr(*map(quoted, keys), "_j", "_s AS _ts", f"{START} AS _pos", f"{cut('_b', START, '_m')} AS _p")
    )


def _broadcast_positions(
    texts: DataFrame, keys: list[str], anchors: DataFrame, search: Search, of_slice: tuple[int, int] = (0, 1)
) -> DataFrame:
    """The shapes (of one slice) broadcast: the text never leaves its task.

    The patterns are broadcast too if they fit; else what was cut out of the
    texts, and nothing more, is shuffled to them, salted against hot patterns.
    """
    kept = [quoted(k) for k in keys]
    held = _candidates(texts, keys, anchors, search, of_slice)
    whole = anchors.selectExpr("_id", "_p", "_m", "_s AS _ts", "_offsets")
    if search.broadcast:
        met = held.join(F.broadcast(whole), ["_p", "_ts"])
    else:
        salts = setting(texts.sparkSession, SALTS)
        dealt = held.selectExpr("*", _salt([*kept, "_pos"], salts))
        met = dealt.join(whole.selectExpr("*", _every_salt(salts)), ["_p", "_ts", "_salt"])
    return met.where(OWN_ANCHOR).select(*keys, "_id", "_m", "_pos")


def _salt(columns: list[str], salts: int) -> str:
    return f"CAST(pmod(xxhash64({', '.join(columns)}), {salts}) AS INT) AS _salt"


def _every_salt(salts: int) -> str:
    return f"explode(sequence(0, {salts - 1})) AS _salt"


def _that_may_meet(windows: DataFrame, shapes: DataFrame, search: Search) -> DataFrame:
    """The windows whose hash is in a bitmap of the shapes' hashes, without a shuffle.

    The bitmap has BITS_PER_ANCHOR bits or more for each anchor that the measured pattern
    table can have, so at most one in that many other windows passes.  It is broadcast in
    rows of 512 words; past its bound all windows are returned.
    """
    most = sum(n * c.stride for c, (n, _) in search.stats.per_class.items())
    log2 = max(15, (most * BITS_PER_ANCHOR - 1).bit_length())
    if 1 << (log2 - 3) > setting(windows.sparkSession, FILTER_BYTES):
        return windows
    spot = f"(_h & {(1 << log2) - 1}L)"
    place = [f"CAST(shiftright({spot}, 15) AS INT) AS _row", f"CAST(shiftright({spot}, 6) & 511 AS INT) AS _word", f"CAST({spot} & 63 AS INT) AS _bit"]
    words = shapes.selectExpr(*place).groupBy("_row", "_word").agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_bits"))
    rows = words.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("_held"))
    rows = rows.selectExpr("_row", "transform(sequence(0, 511), i -> coalesce(try_element_at(_held, i), 0L)) AS _bitmap")
    met = windows.selectExpr("*", *place).join(F.broadcast(rows), "_row")
    return met.where("shiftright(_bitmap[_word], _bit) & 1L = 1L").drop("_row", "_word", "_bit", "_bitmap")


def _shuffled_positions(
    texts: DataFrame, keys: list[str], anchors: DataFrame, search: Search
) -> DataFrame:
    """The same joins where not even the shapes can be broadcast.

    Windows are asked for their bit in a bitmap of the anchors' hashes, and those that may
    meet one are shuffled, without their text.  What survives is matched to slices
    of the text, shuffled once, and the bytes cut there meet the patterns.  Both
    sides of the two pattern joins are salted, so a hot window or a hot pattern
    is spread; a slice is bounded in bytes, so its candidates are too.

    A row is known by 128 bits of its keys and text.  Rows equal in both have equal
    candidates, kept once, and as many equal slices as there are rows: each
    occurrence comes out once per row, whether or not the keys are unique.
    """
    kept = [quoted(k) for k in keys]
    salts = setting(texts.sparkSession, SALTS)
    # the flags tell (NULL, x) from (x, NULL)
    named = [part for k in kept for part in (f"{k} IS NULL", k)]
    own = [f"xxhash64({', '.join([str(seed), *named, '_b'])}) AS _t{seed}" for seed in (1, 2)]
    texts = texts.selectExpr(*kept, *own, "_b")
    shapes = _shapes(anchors, search)
    windows = _that_may_meet(_text_windows(texts, search.classes), shapes, search).selectExpr(
        *kept, "_t1", "_t2", "_n", "_s", "_w", "_h", _salt(["_t1", "_w"], salts)
    )
    shapes = shapes.selectExpr("*", _every_salt(salts))
    candidates = (
        windows.join(shapes, ["_h", "_salt"])
        .where(INSIDE)
        .selectExpr(*kept, "_t1", "_t2", "_s AS _ts", "_j", "_m", f"{START} AS _pos")
        .selectExpr("*", f"_pos - _pos % {FETCH_BLOCK} AS _at")
        .repartition("_t1", "_t2", "_at")
        .distinct()
    )
    length = byte_length("_b")
    slices = (
        texts.where(f"{length} >= 1")
        .selectExpr("_t1", "_t2", "_b", f"explode(sequence(0, {length} - 1, {FETCH_BLOCK})) AS _at")
        .selectExpr("_t1", "_t2", "_at", f"{cut('_b', '_at', str(FETCH_BLOCK + search.stats.max_len))} AS _slice")
    )
    cut_out = candidates.join(slices, ["_t1", "_t2", "_at"]).selectExpr(
        *kept, "_j", "_ts", "_pos", f"{cut('_slice', '_pos - _at', '_m')} AS _p", _salt(["_t1", "_pos"], salts)
    )
    whole = anchors.selectExpr("_id", "_p", "_m", "_s AS _ts", "_offsets", _every_salt(salts))
    met = cut_out.join(whole, ["_p", "_ts", "_salt"])
    return met.where(OWN_ANCHOR).select(*keys, "_id", "_m", "_pos")
