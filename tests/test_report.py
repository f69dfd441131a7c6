import pytest
from helpers import brute, pattern_table, rows, starts, text_table

from bytesift.operators import report
from bytesift.operators.report import compare_strategies, diff_matches, match_report, pattern_totals, strategy_slopes
from bytesift.operators.search import count_matches, find_matches_multi
from bytesift.sources.sinks import write_matches

TEXTS = {0: b"aaaa", 1: b"banana", 2: b"zzz"}
PATTERNS = {0: b"aa", 1: b"ana", 2: b"q", 3: b"zz"}


def tables(spark):
    t, p = text_table(spark, TEXTS), pattern_table(spark, PATTERNS)
    return t, p, find_matches_multi(t, p)


def test_totals_include_zero(spark):
    t, p, matches = tables(spark)
    expected = [(0, 3, 1), (1, 2, 1), (2, 0, 0), (3, 2, 1)]
    for source in (matches, count_matches(t, p)):
        assert rows(pattern_totals(source, p), "pattern_id", "n_matches", "n_texts") == expected


def test_report_order_positions_and_totals(spark):
    _, p, matches = tables(spark)
    lines = [tuple(r) for r in match_report(matches, p).collect()]
    expected = []
    for i, pattern in PATTERNS.items():
        found = [(t, at + 1) for t, body in TEXTS.items() for at in starts(body, pattern)]
        expected += [(i, "match", t, at, None) for t, at in found]
        expected.append((i, "total", None, None, len(found)))
    assert lines == expected


def test_report_limit_keeps_first_and_full_totals(spark):
    _, p, matches = tables(spark)
    lines = [tuple(r) for r in match_report(matches, p, limit=1).collect()]
    assert [x[3] for x in lines if x[1] == "match"] == [1, 2, 1]
    assert [x[4] for x in lines if x[1] == "total"] == [3, 2, 0, 2]


def test_diff(spark):
    _, _, matches = tables(spark)
    assert diff_matches(matches, matches).isEmpty()
    fewer = matches.where("pattern_id <> 1")
    got = rows(diff_matches(matches, fewer), "text_id", "pattern_id", "byte_pos", "side")
    assert got == [(1, 1, 1, "a"), (1, 1, 3, "a")]
    doubled = matches.unionAll(matches.where("pattern_id = 3"))
    got = rows(diff_matches(matches, doubled), "text_id", "pattern_id", "byte_pos", "side")
    assert got == [(2, 3, 0, "b"), (2, 3, 1, "b")]


def test_compare_strategies(spark):
    t, p, _ = tables(spark)
    runs = compare_strategies(t, p, ("scan", "hash"), sizes=(None, 3)).collect()
    assert len(runs) == 4
    assert {r.n_matches for r in runs} == {len(brute(TEXTS, PATTERNS))}
    assert all(r.agrees and r.ms > 0 and r.n_patterns == 4 for r in runs)


def test_strategies_on_more_patterns_than_a_plan_holds(spark):
    """Literals go in passes; each run is stored once and read by the checks."""
    texts = {i: b"abc%d abc%d" % (i, i * 7 % 150) for i in range(200)}
    patterns = {i: b"c%d" % i for i in range(150)}
    runs = compare_strategies(text_table(spark, texts), pattern_table(spark, patterns), ("scan", "hash"), copies=(1, 3)).collect()
    expected = len(brute(texts, patterns))
    assert [(r.strategy, r.copies, r.n_matches, r.agrees) for r in runs] == [
        (s, k, k * expected, True) for k in (1, 3) for s in ("scan", "hash")
    ]
    assert all(r.mb_per_s_core > 0 and r.n_bytes == r.copies * sum(map(len, texts.values())) for r in runs)


@pytest.mark.parametrize("together, block", [(1 << 17, 1 << 13), (3, 4)])
def test_runs_are_compared_by_lists(spark, monkeypatch, together, block):
    """A surplus, a shift or a repeat is told, whatever the order of rows and the cut of lists; ids may be NULL."""
    monkeypatch.setattr(report, "LISTED_TOGETHER", together, raising=False)
    monkeypatch.setattr(report, "LIST_BLOCK", block, raising=False)
    kind = "text_id STRING, pattern_id INT, byte_pos BIGINT"
    listed = [(t, p, at) for t in ("a", "b", None) for p in (1, 2, None) for at in range(0, 40, 3)] + [("a", 1, 3)]

    def lists(rows, parts=1):
        return report._listed(spark.createDataFrame(rows, kind).coalesce(parts))

    once = lists(listed)
    for same in (lists(listed), lists(sorted(listed, key=str)), lists(listed[::-1], 4)):
        assert report._agree(once, same)
    for other in (listed[1:], listed[:-1], listed + listed[:1], [*listed[:-1], ("a", 1, 4)], [*listed[:-1], (None, 1, 3)], []):
        assert not report._agree(once, lists(other)) and not report._agree(lists(other), once)
    assert once.count() < len(listed)


def test_compared_runs_shuffle_lists(spark, monkeypatch):
    """Also ids that Arrow cannot number are compared."""
    t, p, _ = tables(spark)
    calls = []
    monkeypatch.setattr(report, "diff_matches", lambda a, b: calls.append(1) or diff_matches(a, b))
    assert all(r.agrees for r in compare_strategies(t, p, ("scan", "hash")).collect()) and not calls
    nested = t.selectExpr("named_struct('a', text_id) AS text_id", "body")
    runs = compare_strategies(nested, p, ("scan", "hash")).collect()
    assert [(r.agrees, r.n_matches) for r in runs] == [(True, len(brute(TEXTS, PATTERNS)))] * 2 and calls


def test_slopes_are_the_lines_through_the_runs(spark):
    runs = spark.createDataFrame(
        [("hash", None, 1_000_000 * k, 40.0 + 3.0 * k, 10 * k) for k in (1, 10, 40)] + [("scan", 8, 1_000_000, 5.0, 2)],
        "strategy STRING, chunk_size INT, n_bytes BIGINT, ms DOUBLE, n_matches BIGINT",
    )
    line, alone = sorted(strategy_slopes(runs).collect())
    assert (line.n_runs, round(line.start_ms, 6), round(line.ms_per_mb, 6), round(line.n_matches_per_mb, 6)) == (3, 40, 3, 10)
    assert (alone.n_runs, alone.start_ms, alone.ms_per_mb) == (1, None, None)


def test_write_matches(spark, tmp_path):
    _, p, matches = tables(spark)
    plain = write_matches(matches, str(tmp_path / "plain"))
    assert rows(plain) == brute(TEXTS, PATTERNS)
    parted = write_matches(matches, str(tmp_path / "parted"), "pattern_id", patterns=p)
    assert rows(parted) == brute(TEXTS, PATTERNS)
    assert sorted(x.name for x in (tmp_path / "parted" / "matches").glob("pattern_id=*")) == [
        "pattern_id=0", "pattern_id=1", "pattern_id=3",
    ]
    totals = spark.read.parquet(str(tmp_path / "parted" / "totals"))
    assert rows(totals, "pattern_id", "n_matches") == [(0, 3), (1, 2), (2, 0), (3, 2)]


@pytest.mark.parametrize("limit", [1, 3, 5000])
def test_each_task_passes_on_its_first_rows(spark, limit):
    """However many rows are wanted, they are cut in their task, before any shuffle."""
    import random

    rng = random.Random(limit)
    listed = [(rng.randrange(3000), rng.choice([0, 0, 0, 1, 2, None]), rng.randrange(1 << 40)) for _ in range(30_000)]
    matches = spark.createDataFrame(listed, "text_id BIGINT, pattern_id INT, byte_pos BIGINT").repartition(5)
    report = match_report(matches, pattern_table(spark, {i: b"x" for i in range(4)}), limit)
    lines = report._jdf.queryExecution().executedPlan().toString().splitlines()
    (cut,) = [i for i, x in enumerate(lines) if "MapInArrow" in x]
    assert any("Exchange hashpartitioning(pattern_id" in x and "_part" in x for x in lines[:cut])
    got = [(r.pattern_id, r.text_id, r.position - 1) for r in report.collect() if r.kind == "match" and r.pattern_id is not None]
    expected = []
    for p in (0, 1, 2):
        expected += [(p, t, at) for t, at in sorted((t, at) for t, q, at in listed if q == p)[:limit]]
    assert got == expected
