import random

import pytest
from helpers import brute, pattern_table, rows, text_table
from pyspark.sql import functions as F

from bytesift.operators.chunks import chunk_texts, find_matches_chunked
from bytesift.operators.mask import match_mask
from bytesift.operators.search import find_matches_multi
from bytesift.sources.texts import read_text_ranges, read_texts

TEXTS = {0: b"abcabcabc", 1: b"", 2: b"a", 3: b"cabcab\xff\n\xc3cab"}
PATTERNS = {0: b"cab", 1: b"a", 2: b"abcabc", 3: b"\xff\n"}


@pytest.mark.parametrize("strategy", ["scan", "split", "hash"])
def test_every_chunk_size_agrees(spark, strategy):
    t, p = text_table(spark, TEXTS), pattern_table(spark, PATTERNS)
    sizes = range(1, max(map(len, TEXTS.values())) + 2)
    # one table of chunks for all sizes, told apart by the text id
    chunks = None
    for size in sizes:
        cut = chunk_texts(t, size, max_pattern_len=6).withColumn("text_id", F.expr(f"text_id + {100 * size}"))
        chunks = cut if chunks is None else chunks.unionAll(cut)
    expected = [(100 * size + t, i, at) for size in sizes for t, i, at in brute(TEXTS, PATTERNS)]
    assert rows(find_matches_chunked(chunks.coalesce(4), p, strategy)) == expected


def test_every_number_of_splits_agrees(spark):
    t, p = text_table(spark, TEXTS), pattern_table(spark, PATTERNS)
    for k in (1, 2, 3, 8, 100):
        chunks = chunk_texts(t, num_splits=k, max_pattern_len=6, num_partitions=3)
        assert rows(find_matches_chunked(chunks, p)) == brute(TEXTS, PATTERNS), k


def test_chunks_cover_each_byte_once(spark):
    t = text_table(spark, TEXTS)
    for row in chunk_texts(t, 4, max_pattern_len=3).collect():
        text = TEXTS[row.text_id]
        assert bytes(row.body) == text[row.start : row.start + 4 + 2]
        assert row.owned == min(4, len(text) - row.start)
    owned = chunk_texts(t, 4, max_pattern_len=3).groupBy("text_id").sum("owned").collect()
    assert sorted(owned) == [(0, 9), (2, 1), (3, 12)]


def test_short_overlap_fails_instead_of_losing_matches(spark):
    chunks = chunk_texts(text_table(spark, TEXTS), 4, max_pattern_len=5)
    with pytest.raises(Exception, match="overlap is too short"):
        find_matches_chunked(chunks, pattern_table(spark, PATTERNS)).collect()


def test_overlap_is_measured_from_the_patterns(spark, tmp_path):
    rng = random.Random(3)
    texts = {i: bytes(rng.choice(b"ab") for _ in range(rng.randrange(5000))) for i in range(4)}
    patterns = {0: b"aba", 1: texts[0][7:2900], 2: b"", 3: texts[1][-40:]}
    t, p = text_table(spark, texts), pattern_table(spark, patterns)
    renamed = p.withColumnsRenamed({"pattern": "sought"})
    chunks = chunk_texts(t, 100, patterns=renamed, pattern="sought")
    assert {r.overlap for r in chunks.collect()} == {max(map(len, patterns.values())) - 1}
    assert rows(find_matches_chunked(chunks, p)) == brute(texts, patterns)
    for i, text in texts.items():
        (tmp_path / f"{i}.bin").write_bytes(text)
    ranges = read_text_ranges(spark, str(tmp_path), 999, patterns=p)
    assert len(rows(find_matches_chunked(ranges, p))) == len(brute(texts, patterns))
    none = p.where("false")
    assert {r.overlap for r in chunk_texts(t, 100, patterns=none).collect()} == {0}
    for given in ({}, {"patterns": p, "max_pattern_len": 5}, {"max_pattern_len": 0}):
        with pytest.raises(ValueError):
            chunk_texts(t, 100, **given)
        with pytest.raises(ValueError):
            read_text_ranges(spark, str(tmp_path), 100, **given)


def test_ranges_of_a_file_equal_plain_python(spark, tmp_path):
    rng = random.Random(11)
    files = {}
    for name in ("one.bin", "two words.bin"):
        files[name] = bytes(rng.choice(b"abc\n\xff") for _ in range(50_000))
        (tmp_path / name).write_bytes(files[name])
    (tmp_path / "empty.bin").write_bytes(b"")
    patterns = {0: b"abcab", 1: b"\n\xff\n\xff", 2: files["one.bin"][999:1300]}
    p = pattern_table(spark, patterns)
    whole = read_texts(spark, str(tmp_path))
    named = {r.text_id: r.path.rsplit("/", 1)[1] for r in whole.collect()}
    for size in (1000, 7777, 60_000):
        ranges = read_text_ranges(spark, str(tmp_path), size, max_pattern_len=301)
        got = sorted((named[t], i, at) for t, i, at in rows(find_matches_chunked(ranges, p)))
        assert got == brute(files, patterns), size
    got = sorted((named[t], i, at) for t, i, at in rows(find_matches_multi(whole, p)))
    assert got == brute(files, patterns)


def test_listing_ranges_reads_no_content(spark, tmp_path):
    (tmp_path / "x").write_bytes(b"abc")
    plan = read_text_ranges(spark, str(tmp_path), max_pattern_len=9)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]


def test_mask(spark):
    t, p = text_table(spark, TEXTS), pattern_table(spark, PATTERNS)
    masks = match_mask(t, find_matches_multi(t, p)).collect()
    found = brute(TEXTS, PATTERNS)
    expected = {
        (t_id, p_id): [int((t_id, p_id, i) in found) for i in range(len(TEXTS[t_id]))]
        for t_id, p_id, _ in found
    }
    assert {(r.text_id, r.pattern_id): r["mask"] for r in masks} == expected
    with pytest.raises(Exception, match="max_len"):
        match_mask(t, find_matches_multi(t, p), max_len=5).collect()
