import random
import time

import pytest
from helpers import brute, pattern_table, rows, starts

from bytesift.operators.mask import match_mask
from bytesift.operators.patterns import nested_patterns, pattern_profile, validate_patterns
from bytesift.operators.search import find_matches
from bytesift.sources.patterns import read_patterns


def borders(p: bytes) -> list[int]:
    return [
        max((k for k in range(j) if p[:k] == p[j - k : j]), default=0) for j in range(1, len(p) + 1)
    ]


def test_profile_equals_plain_borders(spark):
    rng = random.Random(9)
    patterns = {0: b"a", 1: b"aaaa", 2: b"abab", 3: b"abcabcab", 4: b"\xff\x00\xff", 5: b"abc"}
    for i in range(6, 60):
        patterns[i] = bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 40)))
    for row in pattern_profile(pattern_table(spark, patterns)).collect():
        p = patterns[row.pattern_id]
        expected = borders(p)
        assert row.lps == expected, p
        assert row.len == len(p)
        assert row.longest_border == expected[-1]
        assert row.shortest_period == len(p) - expected[-1]
        assert row.self_overlapping == (expected[-1] > 0)


def test_profile_of_long_patterns_is_linear(spark):
    """64 KiB in seconds, whatever the pattern repeats; a batch is cut by bytes, ids of any type stay."""
    size = 1 << 16
    patterns = {"run": b"a" * size, "end": b"a" * (size - 1) + b"b", "pair": b"ab" * (size // 2), "none": None, "empty": b""}
    fib = [b"b", b"a"]
    while len(fib[-1]) < size:
        fib.append(fib[-1] + fib[-2])
    patterns["fibonacci"] = fib[-1][:size]
    for i in range(40):
        patterns[f"many{i}"] = b"a" * (size - i)
    table = spark.createDataFrame(list(patterns.items()), "pattern_id STRING, pattern BINARY")
    began = time.perf_counter()
    got = {r.pattern_id: r for r in pattern_profile(table).collect()}
    assert time.perf_counter() - began < 30
    assert set(got) == set(patterns) - {"none", "empty"}
    assert got["run"].lps == list(range(size))
    assert got["end"].lps == [*range(size - 1), 0] and not got["end"].self_overlapping
    assert got["pair"].lps == [0, *range(size - 1)] and got["pair"].shortest_period == 2
    assert all(got[f"many{i}"].len == size - i and got[f"many{i}"].shortest_period == 1 for i in range(40))
    known, lps = patterns["fibonacci"], got["fibonacci"].lps
    for j in range(0, size, 997):
        k = lps[j]
        assert known[:k] == known[j + 1 - k : j + 1]
    assert lps[:300] == borders(known[:300])


def test_nested(spark):
    patterns = {0: b"abcabc", 1: b"abc", 2: b"c", 3: b"abc", 4: b"zz"}
    expected = [(o, i, at) for o, i, at in brute(patterns, patterns) if o != i]
    got = rows(nested_patterns(pattern_table(spark, patterns)), "outer_id", "inner_id", "byte_pos")
    assert got == expected


def test_validate(spark):
    table = spark.createDataFrame(
        [(0, b"abc"), (1, None), (2, b""), (3, b"a"), (4, b"abcdef"), (5, b"abc")],
        "pattern_id INT, pattern BINARY",
    )
    assert rows(validate_patterns(table), "pattern_id") == [(0,), (3,), (4,), (5,)]
    assert rows(validate_patterns(table, 2, 5, dedupe=True), "pattern_id") == [(0,)]
    kept = validate_patterns(table, 2, 5, dedupe=True, keep_invalid=True).orderBy("pattern_id")
    assert [r.reason for r in kept.collect()] == [
        None, "null", "empty", "too short", "too long", "duplicate",
    ]


@pytest.mark.parametrize(
    "content, options, expected",
    [
        (b"ab\ncd", {}, [(0, b"ab"), (1, b"cd")]),
        (b"ab\ncd\n", {}, [(0, b"ab"), (1, b"cd")]),
        (b"ab\n\ncd\n", {}, [(0, b"ab"), (2, b"cd")]),
        (b"ab\n\n", {}, [(0, b"ab")]),
        (b"ab\r\ncd\r\n", {}, [(0, b"ab\r"), (1, b"cd\r")]),
        (b"ab\r\ncd\r\n", {"strip_cr": True}, [(0, b"ab"), (1, b"cd")]),
        (b"\xff\xc3\n\x00 \n", {}, [(0, b"\xff\xc3"), (1, b"\x00 ")]),
        (b"\n".join(b"%d" % i for i in range(12)), {"max_patterns": 8}, [(i, b"%d" % i) for i in range(8)]),
        (b"", {}, []),
    ],
)
def test_pattern_file(spark, tmp_path, content, options, expected):
    (tmp_path / "patterns.txt").write_bytes(content)
    table = read_patterns(spark, str(tmp_path / "patterns.txt"), **options)
    assert [(i, bytes(p)) for i, p in rows(table, "pattern_id", "pattern")] == expected


def test_pattern_file_keeps_invalid_on_request(spark, tmp_path):
    (tmp_path / "p").write_bytes(b"a\n\nb\n")
    table = read_patterns(spark, str(tmp_path / "p"), keep_invalid=True).orderBy("pattern_id")
    assert [(r.pattern_id, r.reason) for r in table.collect()] == [(0, None), (1, "empty"), (2, None)]


def test_pattern_list_is_one_file(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"a")
    (tmp_path / "b").write_bytes(b"b")
    with pytest.raises(ValueError, match="one file"):
        read_patterns(spark, str(tmp_path))
    assert starts(b"aa", b"a") == [0, 1]


def test_dedupe_with_repeated_ids(spark):
    rows = [(1, "a"), (1, "b"), (0, "b"), (2, "c"), (2, "d"), (2, "d"), (3, None)]
    patterns = spark.createDataFrame(rows, "pattern_id INT, pattern STRING")
    good = validate_patterns(patterns, dedupe=True)
    assert sorted(map(tuple, good.collect())) == [(0, "b"), (1, "a"), (2, "c"), (2, "d")]


def test_mask_of_long_text_without_a_match(spark):
    texts = spark.createDataFrame([(1, "ab"), (2, "x" * 50)], "text_id BIGINT, body STRING")
    matches = find_matches(texts, "b")
    assert [r.mask for r in match_mask(texts, matches, max_len=10).collect()] == [[0, 1]]


@pytest.mark.parametrize("mark, end", [(b"", b""), (b"\xef\xbb\xbf", b"\n"), (b"\xef\xbb\xbf", b""), (b"", b"\n")])
def test_a_list_is_read_by_byte_ranges(spark, tmp_path, monkeypatch, mark, end):
    """Many ranges give the line numbers of the file; ranges are summed in two levels."""
    from bytesift.sources import patterns

    rng = random.Random(len(mark) + len(end))
    listed = [bytes(rng.choice(b"ab\r\xff\xc3\x00") for _ in range(rng.choice([0, 1, 7, 40, 300]))) for _ in range(400)] + [b"x"]
    raw = mark + b"\n".join(listed) + end
    (tmp_path / "p.txt").write_bytes(raw)
    monkeypatch.setattr(patterns, "STRETCH_BYTES", 4000)
    had = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        table = read_patterns(spark, str(tmp_path / "p.txt"), keep_invalid=True)
        lines = spark.read.option("lineSep", "\n").text(str(tmp_path / "p.txt"))
        assert lines.rdd.getNumPartitions() > 20
        got = {r.pattern_id: bytes(r.pattern) for r in table.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", had)
    listed[0] = mark + listed[0]
    assert got == dict(enumerate(listed))
