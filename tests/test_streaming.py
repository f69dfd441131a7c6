import random

import pandas as pd
import pytest
from helpers import brute, pattern_table, rows, starts, text_table

from bytesift.operators.search import find_matches_multi
from bytesift.streaming import (
    find_across,
    stream_find_across,
    stream_find_matches,
    stream_pattern_totals,
    write_stream_across,
    write_stream_matches,
)

PIECE = "key STRING, turn BIGINT, body BINARY, ts TIMESTAMP"
PATTERNS = {0: b"ab", 1: b"a", 2: b"abaab", 3: b"bbbbbbbbb"}


def write_batches(spark, folder, batches):
    """One Parquet file per batch; file names keep the order."""
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, PIECE).coalesce(1).write.parquet(f"{folder}/b{i:03d}")
    return (
        spark.readStream.schema(PIECE)
        .option("maxFilesPerTrigger", 1)
        .parquet(f"{folder}/b*")
    )


def run(df, name, mode, tmp_path):
    query = (
        df.writeStream.format("memory").queryName(name).outputMode(mode)
        .option("checkpointLocation", str(tmp_path / f"cp-{name}"))
        .trigger(availableNow=True).start()
    )
    try:
        query.awaitTermination(240)
        if query.exception():
            raise RuntimeError(str(query.exception()))
    finally:
        query.stop()
    return df.sparkSession.table(name)


def pieces(seed, keys=4, total=300):
    """Texts by key, and their pieces of 0 to 40 bytes as (key, turn, body)."""
    rng = random.Random(seed)
    texts, cut_up = {}, []
    for k in range(keys):
        text, turn, at = bytes(rng.choice(b"ab") for _ in range(total)), 0, 0
        while at < total:
            n = rng.choice([0, 1, 2, 5, 40])
            cut_up.append((f"k{k}", turn, text[at : at + n]))
            at, turn = at + n, turn + 1
        texts[f"k{k}"] = text
    return texts, cut_up


def stamped(rows_, minute=0):
    import datetime as dt

    at = dt.datetime(2024, 1, 1, 0, minute)
    return [(k, t, bytearray(b), at) for k, t, b in rows_]


def in_batches(cut_up, n, rng):
    """Every key's pieces in order over the batches, shuffled inside a batch."""
    batches = [[] for _ in range(n)]
    for key in sorted({k for k, _, _ in cut_up}):
        mine = [p for p in cut_up if p[0] == key]
        cuts = sorted(rng.sample(range(len(mine)), n - 1))
        for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(mine)])):
            batches[i] += mine[a:b]
    for batch in batches:
        rng.shuffle(batch)
    return [stamped(b) for b in batches]


def test_stream_equals_batch(spark, tmp_path):
    _, cut_up = pieces(1)
    texts = {f"{k}-{t}": b for k, t, b in cut_up}
    named = [(f"{k}-{t}", t, b) for k, t, b in cut_up]
    half = len(named) // 2
    p = pattern_table(spark, PATTERNS)
    stream = write_batches(spark, tmp_path / "in", [stamped(named[:half]), stamped(named[half:])])
    for strategy in ("auto", "hash"):
        df = stream_find_matches(stream, p, strategy, text_id="key")
        assert rows(run(df, f"found_{strategy}", "append", tmp_path)) == brute(texts, PATTERNS)


def test_stream_to_files_with_any_number_of_patterns(spark, tmp_path):
    _, cut_up = pieces(2)
    texts = {f"{k}-{t}": b for k, t, b in cut_up}
    named = stamped([(f"{k}-{t}", t, b) for k, t, b in cut_up])
    stream = write_batches(spark, tmp_path / "in", [named[:9], named[9:]])
    p = pattern_table(spark, PATTERNS)
    spark.conf.set("spark.bytesift.broadcastBytes", "0")
    try:
        df = stream_find_matches(stream, p, "hash", text_id="key")
        assert rows(run(df, "passes", "append", tmp_path)) == brute(texts, PATTERNS)
        query = write_stream_matches(
            stream, p, str(tmp_path / "out"), str(tmp_path / "cp"), text_id="key", strategy="hash"
        )
        query.awaitTermination(240)
        assert query.exception() is None
    finally:
        spark.conf.unset("spark.bytesift.broadcastBytes")
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == brute(texts, PATTERNS)


def test_running_totals(spark, tmp_path):
    _, cut_up = pieces(3)
    stream = write_batches(spark, tmp_path / "in", [stamped(cut_up[:20]), stamped(cut_up[20:])])
    df = stream_pattern_totals(stream, pattern_table(spark, PATTERNS))
    expected = [(i, sum(len(starts(b, p)) for _, _, b in cut_up)) for i, p in PATTERNS.items()]
    got = rows(run(df, "totals", "complete", tmp_path), "pattern_id", "n_matches")
    assert got == [e for e in expected if e[1]]


def test_windowed_totals_with_watermark(spark, tmp_path):
    _, cut_up = pieces(4)
    a, b, c = cut_up[:20], cut_up[20:40], cut_up[40:41]
    # Spark filters late rows by the watermark of the batch before: hence two at 40
    batches = [stamped(a, 1), stamped(b, 12), stamped(c, 40), stamped(c, 40), stamped(a, 2)]
    stream = write_batches(spark, tmp_path / "in", batches)
    df = stream_pattern_totals(
        stream, pattern_table(spark, PATTERNS), event_time="ts", window="10 minutes", watermark="5 minutes"
    )
    got = rows(run(df, "windowed", "append", tmp_path).selectExpr(
        "minute(window_start) AS m", "pattern_id", "n_matches"), "m", "pattern_id", "n_matches")
    count = lambda part, p: sum(len(starts(x, p)) for _, _, x in part)
    expected = sorted(
        (m, i, count(part, p)) for m, part in ((0, a), (10, b)) for i, p in PATTERNS.items() if count(part, p)
    )
    # both windows closed, the late second copy of a dropped
    assert got == expected
    with pytest.raises(ValueError):
        stream_pattern_totals(stream, pattern_table(spark, PATTERNS), window="1 minute")


def test_a_stream_takes_more_anchors_than_may_be_broadcast(spark, tmp_path, monkeypatch):
    """In several passes, each over a slice of the anchors."""
    from bytesift.operators import windowed

    monkeypatch.setattr(windowed, "LEAST_SLICE", 200)
    rng = random.Random(3)
    patterns = {i: bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 30))) for i in range(20)}
    _, cut_up = pieces(9, keys=2, total=120)
    texts = {f"{k}-{t}": b for k, t, b in cut_up}
    stream = write_batches(spark, tmp_path / "in", [stamped([(f"{k}-{t}", t, b) for k, t, b in cut_up])])
    spark.conf.set("spark.bytesift.broadcastBytes", "0")
    try:
        df = stream_find_matches(stream, pattern_table(spark, patterns), "hash", text_id="key")
        assert df._jdf.queryExecution().analyzed().toString().count("Union") >= 1
        got = rows(run(df, "slices", "append", tmp_path))
    finally:
        spark.conf.unset("spark.bytesift.broadcastBytes")
    assert got == brute(texts, patterns)


def test_sliding_totals_with_zeros(spark, tmp_path):
    """Each closed window has every pattern; late texts count in no closed window."""
    import datetime as dt

    _, cut_up = pieces(4)
    a, b = cut_up[:20], cut_up[20:40]
    nothing = [("k", 0, b"zzz")]
    feeds = [stamped(a, 1) + stamped(nothing, 16), stamped(a, 2) + stamped(b, 17), stamped(nothing, 59)]
    p = pattern_table(spark, {**PATTERNS, 9: b"never"})
    out = str(tmp_path / "out")

    def start(stream):
        df = stream_pattern_totals(stream, p, "ts", "10 minutes", "5 minutes", "1 minute", zeros=True)
        return (
            df.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp"))
            .trigger(availableNow=True).start()
        )

    fed(spark, tmp_path, feeds, start)
    got = rows(spark.read.parquet(out).selectExpr("minute(window_start) AS m", "hour(window_start) AS h", "pattern_id", "n_matches"), "h", "m", "pattern_id", "n_matches")
    count = lambda part, q: sum(len(starts(x, q)) for _, _, x in part)
    expected = []
    for h, m, part in ((23, 55, a), (0, 0, a), (0, 10, b), (0, 15, b)):  # the first two closed before a came again
        expected += [(h, m, i, count(part, q)) for i, q in {**PATTERNS, 9: b"never"}.items()]
    assert got == sorted(expected)
    with pytest.raises(ValueError, match="watermark"):
        stream_pattern_totals(spark.readStream.schema(PIECE).parquet(f"{tmp_path}/in/b*"), p, "ts", "10 minutes", zeros=True)


@pytest.mark.parametrize("dense", [True, False])
def test_matches_across_pieces(spark, tmp_path, dense):
    texts, cut_up = pieces(5)
    batches = in_batches(cut_up, 3, random.Random(6))
    stream = write_batches(spark, tmp_path / "in", batches)
    df = stream_find_across(
        stream, "key", "turn", pattern_table(spark, PATTERNS),
        first_order=0 if dense else None, num_partitions=3 if dense else None,
    )
    got = rows(run(df, f"across_{dense}", "append", tmp_path), "key", "pattern_id", "byte_pos")
    assert got == brute(texts, PATTERNS)


def test_early_pieces_wait_for_their_predecessors(spark, tmp_path):
    texts, cut_up = pieces(7, keys=3, total=120)
    random.Random(8).shuffle(cut_up)
    n = len(cut_up) // 3
    batches = [stamped(cut_up[:n]), stamped(cut_up[n : 2 * n]), stamped(cut_up[2 * n :])]
    stream = write_batches(spark, tmp_path / "in", batches)
    df = stream_find_across(stream, "key", "turn", pattern_table(spark, PATTERNS), first_order=0)
    got = rows(run(df, "early", "append", tmp_path), "key", "pattern_id", "byte_pos")
    assert got == brute(texts, PATTERNS)


class Value:
    """A stand-in for the state of one key."""

    def __init__(self):
        self.held = None

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value

    def clear(self):
        self.held = None


class Entries(dict):
    containsKey, getValue, updateValue, removeKey = dict.__contains__, dict.__getitem__, dict.__setitem__, dict.pop


class Handle:
    def __init__(self):
        self.value, self.entries, self.timers = Value(), Entries(), set()

    def getValueState(self, *_):
        return self.value

    def getMapState(self, *_):
        return self.entries

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


class Clock:
    now = 1000

    def getCurrentProcessingTimeInMs(self):
        return self.now


def test_stitching_emits_bounded_rows(monkeypatch):
    """However the rows are cut, each match ends in the new bytes of one row."""
    from bytesift.streaming import across

    text = b"abaababaabaaabababbabaab" * 5
    for limit in (1, 3, 10, 1000):
        monkeypatch.setattr(across, "ROW_BYTES", limit)
        found, step = [], across._stitcher(4, 0, None, False)
        step.init(Handle())
        for first in range(0, len(text), 12):
            orders = list(range(first, min(first + 12, len(text))))
            batch = pd.DataFrame({"number": orders, "body": [text[i : i + 1] for i in orders]})
            for row in step.handleInputRows(("k",), [batch], Clock()):
                body, start, seen = row["_b"][0], row["start"][0], row["seen"][0]
                assert len(body) - seen <= limit + 12
                for p in (b"ab", b"a", b"abaab"):
                    found += [(p, start + i) for i in starts(body, p) if i + len(p) > seen]
        expected = [(p, i) for p in (b"ab", b"a", b"abaab") for i in starts(text, p)]
        assert sorted(found) == sorted(expected), limit


def test_a_key_ends_once_and_leaves_no_state():
    from bytesift.streaming import across

    handle, clock, step = Handle(), Clock(), across._stitcher(4, 0, 50, False)
    step.init(handle)

    def feed(*orders):
        frame = pd.DataFrame({"number": orders, "body": [b"ab"] * len(orders)})
        return pd.concat([pd.DataFrame(), *step.handleInputRows(("k",), [frame], clock)])

    feed(0, 3, 4)
    assert handle.timers == {1050} and sorted(handle.entries) == [(3,), (4,)]
    clock.now = 1020
    assert feed(0, 3, 1).query("reason.notna()")["piece"].tolist() == [0, 3]
    assert handle.timers == {1070} and handle.value.held[2] == 1
    gone = pd.concat(step.handleExpiredTimer(("k",), clock, None))
    assert gone[["piece", "reason"]].values.tolist() == [[3, across.GAP], [4, across.GAP]]
    assert not handle.value.exists() and not handle.entries


def fed(spark, folder, batches, run_one):
    """Runs a query to its end after each batch, always from the same checkpoint."""
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, PIECE).write.parquet(f"{folder}/in/b{i:03d}")
        query = run_one(spark.readStream.schema(PIECE).parquet(f"{folder}/in/b*"))
        query.awaitTermination(240)
        assert query.exception() is None


def test_late_repeated_and_lost_pieces_are_stored_aside(spark, tmp_path):
    """By event time: a key ends when the watermark has passed it; another text may follow."""
    texts, cut_up = pieces(12, keys=2, total=60)
    p = pattern_table(spark, PATTERNS)
    k0, k1 = ([c for c in cut_up if c[0] == k] for k in ("k0", "k1"))
    batches = [
        stamped(k0[:3] + k1[:2] + k1[3:5]),  # k1 lacks its piece 2
        stamped(k0[3:] + k0[:1] + k1[3:4], 1),  # a repeated and a late one
        stamped([("k9", 0, b"ab")], 50),  # closes both keys
        stamped([("k9", 1, b"ab")], 51),
        stamped(k0, 52),  # a new text of that name
    ]

    def start(stream):
        return write_stream_across(
            stream, "key", "turn", p, str(tmp_path / "out"), str(tmp_path / "cp"), first_order=0,
            timeout="10 minutes", event_time="ts", watermark="1 minute",
        )

    fed(spark, tmp_path, batches, start)
    refused = spark.read.parquet(str(tmp_path / "out" / "refused")).drop("batch")
    assert rows(refused, "key", "piece", "reason") == [
        ("k0", 0, "late or repeated"), ("k1", 3, "late or repeated"), ("k1", 3, "no predecessor"), ("k1", 4, "no predecessor")
    ]
    whole = {"k0": texts["k0"], "k1": b"".join(c[2] for c in k1[:2]), "k9": b"abab"}
    expected = brute(whole, PATTERNS) + brute({"k0": texts["k0"]}, PATTERNS)
    got = spark.read.parquet(str(tmp_path / "out" / "matches"))
    assert rows(got, "key", "pattern_id", "byte_pos") == sorted(expected)


def test_late_pieces_do_not_fail_a_stream_without_numbering(spark, tmp_path):
    stream = write_batches(
        spark, tmp_path / "in", [stamped([("k", 5, b"ab")]), stamped([("k", 4, b"ab"), ("k", 9, b"ab")])]
    )
    df = stream_find_across(stream, "key", "turn", pattern_table(spark, PATTERNS))
    got = rows(run(df, "late", "append", tmp_path), "key", "pattern_id", "byte_pos")
    assert got == brute({"k": b"abab"}, PATTERNS)
    with pytest.raises(ValueError, match="watermark"):
        stream_find_across(stream, "key", "turn", pattern_table(spark, PATTERNS), event_time="ts")


def test_every_cut_gives_the_batch_answer(spark):
    text = b"abaabaabbbbbbbbbbbaab"
    keyed, cut_up = {}, []
    for i in range(len(text) + 1):
        for j in sorted({i, min(i + 3, len(text))}):
            key = f"{i}-{j}"
            keyed[key] = text
            # order numbers with gaps, negative ones too
            cut_up += [(key, -7, text[:i]), (key, 100, text[i:j]), (key, 5000, text[j:])]
    table = spark.createDataFrame(stamped(cut_up), PIECE)
    p = pattern_table(spark, PATTERNS)
    for block in (1, 4, 7, 1 << 16):
        got = rows(find_across(table, "key", "turn", p, block), "key", "pattern_id", "byte_pos")
        assert got == brute(keyed, PATTERNS), block


def test_batch_twin_of_random_pieces(spark):
    texts, cut_up = pieces(10, keys=6, total=900)
    table = spark.createDataFrame(stamped(cut_up), PIECE)
    got = rows(find_across(table, "key", "turn", pattern_table(spark, PATTERNS), 64), "key", "pattern_id", "byte_pos")
    assert got == brute(texts, PATTERNS)
    whole = rows(find_matches_multi(text_table(spark, {0: texts["k0"]}), pattern_table(spark, PATTERNS)))
    assert [r[1:] for r in whole] == [r[1:] for r in got if r[0] == "k0"]


def test_repeated_order_numbers_fail_in_the_batch_twin(spark):
    table = spark.createDataFrame(stamped([("k", 1, b"ab"), ("k", 1, b"ba"), ("k", 2, b"a")]), PIECE)
    with pytest.raises(Exception, match="repeated"):
        find_across(table, "key", "turn", pattern_table(spark, PATTERNS)).collect()


def test_ranges_of_pieces_follow_the_order_numbers(spark):
    """Epoch seconds and an outlier: ranges are cut by how many pieces there are."""
    from bytesift.streaming import across

    rng = random.Random(13)
    n = 10_000
    orders = rng.sample(range(1_700_000_000, 1_700_400_000), n) + [1]
    table = spark.createDataFrame([("k", o, bytearray(b"ab")) for o in orders], "key STRING, _order BIGINT, _b BINARY").repartition(4)
    ranged = across._in_ranges(table)
    assert ranged.groupBy("key", "_range").count().agg({"count": "max"}).first()[0] < 2 * n**0.5
    placed = across._with_offsets(table).select("_from").collect()
    assert sorted(r["_from"] for r in placed) == list(range(0, 2 * len(orders), 2))
