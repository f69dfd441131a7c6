import random

import pytest
from helpers import brute, pattern_table, rows, starts, text_table

from bytesift.operators.search import (
    contains_filter,
    count_matches,
    find_matches,
    find_matches_multi,
    hash_join_matches,
    normal_patterns,
    normal_texts,
    positions,
)
from bytesift.plans import choose, pattern_stats, window_classes
from bytesift.plans.choice import shape_bytes

EDGE_CASES = [
    (b"aaaa", b"aa", [0, 1, 2]),
    ("a.a.a\U0001f600a.a".encode(), b"a.a", [0, 2, 9]),
    ("éaaéaa".encode(), b"aa", [2, 6]),
    ("éaaéaa".encode(), "é".encode(), [0, 4]),
    (b"abc", b"abc", [0]),
    (b"ab", b"abc", []),
    (b"", b"a", []),
    (b"a\nb\n", b"\n", [1, 3]),
    (b"\xc3\x61\xff\x61", b"\x61", [1, 3]),
    (b"x\\Ey", b"\\E", [1]),
    (b"abcabcabc", b"cab", [2, 5]),
    (b"c[ab", b"ab", [2]),
    (b"anything", b"zzzzqq", []),
    (b"\x00\x00\x00", b"\x00\x00", [0, 1]),
    (b"a" * 200, b"a" * 70, list(range(131))),
]


@pytest.mark.parametrize("strategy", ["auto", "scan", "split", "hash"])
def test_edge_cases(spark, strategy):
    patterns = sorted({p for _, p, _ in EDGE_CASES})
    texts = text_table(spark, dict(enumerate(t for t, _, _ in EDGE_CASES)))
    for p in patterns:
        expected = sorted((i, 0, s) for i, (t, _, _) in enumerate(EDGE_CASES) for s in starts(t, p))
        assert rows(find_matches(texts, p, strategy)) == expected
        if strategy == "hash":
            break  # the multi-pattern test below covers the rest in one job
    for i, (t, p, want) in enumerate(EDGE_CASES):
        assert starts(t, p) == want, i


def random_bytes(rng, alphabet, n):
    return bytes(rng.choice(alphabet) for _ in range(n))


ALPHABETS = [b"a", b"ab", b"abcd", b"\x00\xff\n\r\xc2\x85\\E.Q", bytes(range(256))]


def random_case(seed):
    rng = random.Random(seed)
    texts, patterns = {}, {}
    for alphabet in ALPHABETS:
        for _ in range(6):
            texts[len(texts)] = random_bytes(rng, alphabet, rng.choice([0, 1, 3, 40, 300]))
        long = max(texts.values(), key=len)
        for n in (1, 2, 3, 5, 9, 20, 31, 45, 63, 64, 100):
            at = rng.randrange(max(1, len(long) - n))
            patterns[len(patterns)] = long[at : at + n] or b"x"
            patterns[len(patterns)] = random_bytes(rng, alphabet, n)
    return texts, patterns


@pytest.mark.parametrize("seed", [1, 2])
def test_hash_join_equals_brute_force(spark, seed):
    texts, patterns = random_case(seed)
    t, p = text_table(spark, texts), pattern_table(spark, patterns)
    expected = brute(texts, patterns)
    assert len(expected) > 1000
    assert rows(find_matches_multi(t, p)) == expected
    for q, stride in [(32, 32), (16, 8), (7, 5), (1, 1), (3, 20)]:
        assert rows(hash_join_matches(t, p, q, stride)) == expected, (q, stride)


@pytest.mark.parametrize("salts", ["1", "3"])
def test_shuffled_hash_join_equals_brute_force(spark, salts):
    texts, patterns = random_case(3)
    spark.conf.set("spark.bytesift.broadcastBytes", "0")
    spark.conf.set("spark.bytesift.salts", salts)
    try:
        found = find_matches_multi(text_table(spark, texts), pattern_table(spark, patterns))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "_salt" in plan
        assert rows(found) == brute(texts, patterns)
    finally:
        spark.conf.unset("spark.bytesift.broadcastBytes")
        spark.conf.unset("spark.bytesift.salts")


@pytest.mark.parametrize("bound", ["0", "shapes", "268435456"])
def test_repeated_ids_and_no_keys_do_not_depend_on_the_bound(spark, bound):
    texts = [(1, "xxabxx"), (1, "ababab"), (1, "ababab"), (None, "ab"), (2, "a long text, with a long pattern in it")]
    t = spark.createDataFrame(texts, "text_id BIGINT, body STRING")
    patterns = [(0, "ab"), (0, "ba"), (0, "ab"), (None, "xx"), (7, "a long pattern")]
    p = spark.createDataFrame(patterns, "pattern_id INT, pattern STRING")
    bare = normal_patterns(p, "pattern_id", "pattern")
    if bound == "shapes":
        bound = str(shape_bytes(pattern_stats(bare, window_classes()), 32))
    spark.conf.set("spark.bytesift.broadcastBytes", bound)
    try:
        search = choose(bare, "hash")
        assert search.broadcast is (bound == "268435456") and search.broadcast_shapes is (bound != "0")
        got = [tuple(r) for r in find_matches_multi(t, p, "hash").collect()]
        bodies = normal_texts(t, {}, "body")
        n = positions(bodies, [], bare, search).count()
    finally:
        spark.conf.unset("spark.bytesift.broadcastBytes")
    want = [(i, j, s) for i, b in texts for j, x in patterns for s in starts(b.encode(), x.encode())]
    assert sorted(got, key=str) == sorted(want, key=str) and n == len(want)


@pytest.mark.parametrize("strategy", ["scan", "split"])
def test_literal_strategies_equal_brute_force(spark, strategy):
    texts, patterns = random_case(4)
    t = text_table(spark, texts)
    ids = list(patterns)
    for first in range(0, len(ids), 8):
        some = {i: patterns[i] for i in ids[first : first + 8]}
        assert rows(find_matches_multi(t, pattern_table(spark, some), strategy)) == brute(texts, some)


def test_literal_strategies_refuse_many_patterns(spark):
    many = pattern_table(spark, {i: b"%d" % i for i in range(100)})
    with pytest.raises(ValueError, match="hash"):
        find_matches_multi(text_table(spark, {0: b"1"}), many, "scan")


def test_long_text_crosses_stretches_and_blocks(spark):
    rng = random.Random(5)
    body = bytearray(random_bytes(rng, b"abcdefgh", 3_000_000))
    needle = b"0123456789" * 30
    for at in (0, (1 << 20) - 150, (1 << 20) - 1, 2_000_000, len(body) - len(needle)):
        body[at : at + len(needle)] = needle
    for at in range(4096 * 3 - 3, 4096 * 3 + 3):
        body[at : at + 3] = b"xyz"
    texts, patterns = {7: bytes(body)}, {0: needle, 1: b"xyz", 2: b"0123456789012"}
    t, p = text_table(spark, texts), pattern_table(spark, patterns)
    expected = sorted(
        (7, i, at) for i, pat in patterns.items() for at in _find_all(bytes(body), pat)
    )
    for strategy in ("scan", "split", "hash"):
        assert rows(find_matches_multi(t, p, strategy)) == expected, strategy
    counts = rows(count_matches(t, p), "pattern_id", "n_matches")
    assert counts == [(i, sum(1 for e in expected if e[1] == i)) for i in patterns]


def _find_all(text, pattern):
    at = text.find(pattern)
    while at >= 0:
        yield at
        at = text.find(pattern, at + 1)


def test_shared_windows_do_not_pair_every_pattern(spark):
    """A third of the patterns share their windows; every match still once."""
    common = b"# Permission is granted to anyone to use this text freely. " * 2
    patterns = {i: common + b"%05d" % i + common for i in range(300)}
    patterns[300] = b" " * 90
    patterns[301] = b" " * 90  # same bytes, another id
    texts = {0: patterns[17] + b"--" + patterns[250], 1: b" " * 400, 2: common * 3, 3: b"x" * 31}
    t, p = text_table(spark, texts), pattern_table(spark, patterns)
    assert rows(find_matches_multi(t, p)) == brute(texts, patterns)


@pytest.mark.parametrize("strategy", ["scan", "split", "hash"])
def test_counts(spark, strategy):
    texts, _ = random_case(6)
    patterns = {0: b"aa", 1: b"ab", 2: b"aba", 3: b"\xff", 4: b"\\E", 5: b"\n", 6: b"a"}
    got = rows(
        count_matches(text_table(spark, texts), pattern_table(spark, patterns), strategy),
        "text_id",
        "pattern_id",
        "n_matches",
    )
    expected = sorted(
        (t, p, len(starts(b, x))) for t, b in texts.items() for p, x in patterns.items() if starts(b, x)
    )
    assert got == expected


def test_string_columns_other_names_and_nulls(spark):
    t = spark.createDataFrame([(1, "éaa"), (2, None), (3, "")], "doc BIGINT, words STRING")
    p = spark.createDataFrame([("x", "aa"), ("y", "é"), ("z", ""), ("n", None)], "name STRING, w STRING")
    for strategy in ("auto", "scan", "split", "hash"):
        got = find_matches_multi(
            t, p, strategy, text_id="doc", body="words", pattern_id="name", pattern="w"
        )
        assert rows(got) == [(1, "x", 2), (1, "y", 0)]


def test_no_usable_pattern(spark):
    t = text_table(spark, {0: b"abc"})
    none = spark.createDataFrame([(0, None), (1, bytearray(b""))], "pattern_id INT, pattern BINARY")
    for strategy in ("auto", "scan", "split", "hash"):
        assert rows(find_matches_multi(t, none, strategy)) == []
    assert rows(count_matches(t, none), "text_id", "pattern_id", "n_matches") == []


def test_contains_filter(spark):
    t = spark.createDataFrame([(1, "a.b"), (2, "ab"), (3, None)], "text_id BIGINT, body STRING")
    assert rows(contains_filter(t, "."), "text_id") == [(1,)]
    assert rows(contains_filter(t, ".", negate=True), "text_id") == [(2,), (3,)]
    assert rows(contains_filter(t, b"\xff", negate=True), "text_id") == [(1,), (2,), (3,)]
    with pytest.raises(ValueError):
        contains_filter(t, "")


def test_patterns_of_many_lengths_with_one_prefix(spark):
    """Of the lengths that share a window only those whose end stands there are cut out."""
    from bytesift.operators import windowed

    rng = random.Random(11)
    prefix = bytes(rng.choice(b"abcdefgh") for _ in range(70))
    patterns = {k: prefix + bytes(rng.choice(b"ijklm") for _ in range(k)) for k in range(1, 1500)}
    texts = {i: bytes(rng.choice(b"nop") for _ in range(rng.randint(0, 50))) + patterns[rng.randint(1, 1499)] + b"q" * 1500 for i in range(12)}
    texts[99] = prefix * 30
    table, listed = text_table(spark, texts), pattern_table(spark, patterns)
    got = rows(find_matches_multi(table, listed, "hash"))
    assert got == brute(texts, patterns) and len(got) >= 12
    bare = listed.selectExpr("pattern_id AS _id", "pattern AS _p")
    search = choose(bare, "hash")
    sliced = table.selectExpr("text_id", "body AS _b")
    windows = windowed._text_windows(sliced, search.classes).count()
    found = windowed._candidates(sliced, ["text_id"], windowed.anchored(bare, search.classes), search)
    assert found.count() <= 2 * (len(got) + windows)


def test_a_shape_of_many_ends_takes_any(spark, monkeypatch):
    from bytesift.operators import windowed

    monkeypatch.setattr(windowed, "ENDS_KEPT", 3)
    rng = random.Random(12)
    prefix = b"a prefix that is longer than two windows of the longest class, and more"
    patterns = {k: prefix + b"%05d" % k for k in range(40)}
    texts = {i: b"x" * rng.randint(0, 40) + patterns[rng.randrange(40)] + patterns[rng.randrange(40)] for i in range(10)}
    got = rows(find_matches_multi(text_table(spark, texts), pattern_table(spark, patterns), "hash"))
    assert got == brute(texts, patterns)
