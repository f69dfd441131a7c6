"""Plans that must hold at any size of data."""

import pytest
from pyspark.sql import functions as F
from helpers import pattern_table

from bytesift.operators.report import pattern_totals
from bytesift.operators.search import contains_filter, find_matches, find_matches_multi
from bytesift.plans import WindowClass, choose, fresh_folder, pattern_stats, spread, window_classes
from bytesift.plans.choice import PatternStats, anchor_bytes, shape_bytes
from bytesift.sources.texts import read_texts

MANY = {i: b"pattern number %05d, long enough for the longest of the windows" % i for i in range(80)}


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("plans") / "texts")
    rows = [(i, f"text {i}", "unused") for i in range(100)]
    spark.createDataFrame(rows, "text_id BIGINT, body STRING, extra STRING").coalesce(1).write.parquet(folder)
    return folder


def test_hash_join_is_broadcast_and_never_cartesian(spark, stored):
    plan = physical(find_matches_multi(spark.read.parquet(stored), pattern_table(spark, MANY)))
    assert plan.count("BroadcastHashJoin") == 2
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    # the only exchanges are the two broadcasts: the text is not shuffled
    assert "Exchange hashpartitioning" not in plan


def test_shuffled_join_is_salted_and_never_cartesian(spark, stored):
    """As planned where not even a bitmap of the anchors can be broadcast."""
    spark.conf.set("spark.bytesift.broadcastBytes", "0")
    spark.conf.set("spark.bytesift.filterBytes", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(find_matches_multi(spark.read.parquet(stored), pattern_table(spark, MANY)))
    finally:
        spark.conf.unset("spark.bytesift.broadcastBytes")
        spark.conf.unset("spark.bytesift.filterBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" not in plan and "Cartesian" not in plan
    assert plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin") == 3
    # a row is matched to its slices by what it holds, and never by the offset alone
    assert any("_t1#" in x and "_t2#" in x and "_at#" in x for x in plan.splitlines() if "Join [" in x)
    joins = [line for line in plan.splitlines() if "Join [" in line]
    assert sum("_salt" in line for line in joins) == 2
    # windows travel to the first join without their text
    (line,) = [x for x in plan.splitlines() if "Exchange hashpartitioning(_h#" in x and "_salt" in x][:1]
    below = plan.splitlines()[plan.splitlines().index(line) + 1]
    assert "_b#" not in below.split("AS _h")[-1]


def test_scan_has_no_exchange(spark, stored):
    plan = physical(find_matches(spark.read.parquet(stored), "text"))
    assert "Exchange" not in plan and "Join" not in plan


def test_contains_is_pushed_and_columns_are_pruned(spark, stored):
    texts = spark.read.parquet(stored)
    for df in (
        contains_filter(texts, "7").select("text_id"),
        find_matches(texts, "7"),
    ):
        plan = physical(df)
        assert "StringContains(body,7)" in plan
        assert "extra" not in plan.split("ReadSchema")[1]
    negated = physical(contains_filter(texts, "7", negate=True))
    assert "Not(StringContains(body,7))" in negated


def test_totals_are_partial_before_each_shuffle(spark, stored):
    p = pattern_table(spark, MANY)
    totals = pattern_totals(find_matches_multi(spark.read.parquet(stored), p), p)
    assert physical(totals).count("partial_count") >= 2


def test_spread_leaves_large_scans_alone(spark, stored):
    texts = spark.read.parquet(stored)
    assert "Exchange" in physical(spread(texts, "text_id", 3))
    assert "Exchange" not in physical(spread(texts, "text_id", 1))
    assert "Exchange" in physical(read_texts(spark, stored, "parquet"))


def test_window_classes():
    assert [(c.q, c.stride, c.min_len) for c in window_classes()] == [
        (32, 32, 63), (16, 16, 31), (8, 8, 15), (6, 2, 7), (3, 1, 3), (2, 1, 2), (1, 1, 1),
    ]
    assert window_classes(1, 1) == [WindowClass(1, 1)]
    for top in [(1, 40), (40, 1), (7, 5), (3, 20), (100, 64)]:
        lengths = [c.min_len for c in window_classes(*top)]
        assert lengths == sorted(lengths, reverse=True) and lengths[-1] == 1
    with pytest.raises(ValueError):
        window_classes(0, 4)


def test_choice(spark):
    few = pattern_table(spark, {0: b"ab", 1: b"cd"}).selectExpr("pattern_id AS _id", "pattern AS _p")
    many = pattern_table(spark, MANY).selectExpr("pattern_id AS _id", "pattern AS _p")
    assert choose(few).strategy == "scan"
    chosen = choose(many)
    assert (chosen.strategy, chosen.broadcast) == ("hash", True)
    assert chosen.classes == [WindowClass(32, 32)] or chosen.classes == [WindowClass(16, 16)]
    with pytest.raises(ValueError):
        choose(few, "guess")
    stats = pattern_stats(many, window_classes())
    assert stats.count == 80 and stats.total_bytes == sum(map(len, MANY.values()))


def test_stride_shrinks_before_the_broadcast_is_given_up(spark):
    long = {i: b"pattern number %05d, " % i * 10 for i in range(80)}
    many = pattern_table(spark, long).selectExpr("pattern_id AS _id", "pattern AS _p")
    stats = pattern_stats(many, window_classes())
    strides = [32, 16, 8, 4, 2, 1]
    sizes = [anchor_bytes(stats, s) for s in strides]
    assert sizes == sorted(sizes, reverse=True) and shape_bytes(stats, 1) < sizes[-1]
    cases = [(size, True, True, s) for size, s in zip(sizes, strides)]
    cases += [(shape_bytes(stats, 4), False, True, 4), (shape_bytes(stats, 1) - 1, False, False, 32)]
    try:
        for limit, broadcast, shapes, stride in cases:
            spark.conf.set("spark.bytesift.broadcastBytes", str(limit))
            chosen = choose(many, "hash")
            assert (chosen.broadcast, chosen.broadcast_shapes) == (broadcast, shapes)
            # the window stays as long as it was
            assert [(c.q, c.stride) for c in chosen.classes] == [(32, stride)]
    finally:
        spark.conf.unset("spark.bytesift.broadcastBytes")
    assert isinstance(stats, PatternStats)
    wide = many.selectExpr("repeat(CAST(_id AS STRING), 1000) AS _id", "_p")
    assert anchor_bytes(pattern_stats(wide, window_classes()), 32) > sizes[0] + 80_000


def test_text_is_not_shuffled_while_the_shapes_fit(spark, stored):
    texts, patterns = spark.read.parquet(stored), pattern_table(spark, MANY)
    stats = pattern_stats(patterns.selectExpr("pattern_id AS _id", "pattern AS _p"), window_classes())
    spark.conf.set("spark.bytesift.broadcastBytes", str(shape_bytes(stats, 1)))
    try:
        chosen = choose(patterns.selectExpr("pattern_id AS _id", "pattern AS _p"), "hash")
        plan = physical(find_matches_multi(texts, patterns, "hash"))
    finally:
        spark.conf.unset("spark.bytesift.broadcastBytes")
    assert (chosen.broadcast, chosen.broadcast_shapes) == (False, True)
    exchanged = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "_salt" in x]
    assert exchanged and "_at#" not in plan


def test_windows_are_filtered_before_they_are_shuffled(spark, stored):
    """A bitmap of the anchors is asked first: what may not meet one is in no exchange."""
    texts = spark.read.parquet(stored)
    patterns = pattern_table(spark, {**MANY, 90: b"text 7", 91: b"xt 42"})
    spark.conf.set("spark.bytesift.broadcastBytes", "0")
    try:
        df = find_matches_multi(texts, patterns, "hash")
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
        # what is shuffled of the windows has met the bitmap just below
        (shuffled,) = [i for i, x in enumerate(lines) if "Exchange hashpartitioning(_h#" in x and "_salt" in x][:1]
        (bitmap,) = [i for i, x in enumerate(lines) if "BroadcastHashJoin [_row#" in x and "_bitmap#" in x]
        assert shuffled < bitmap and not any("Exchange" in x for x in lines[shuffled + 1 : bitmap])
        expected = sorted(map(tuple, df.collect()))
        spark.conf.set("spark.bytesift.filterBytes", "0")
        without = find_matches_multi(texts, patterns, "hash")
        assert "_bitmap" not in physical(without)
        assert sorted(map(tuple, without.collect())) == expected
        assert len(expected) == 12
    finally:
        spark.conf.unset("spark.bytesift.broadcastBytes")
        spark.conf.unset("spark.bytesift.filterBytes")


def test_the_bitmap_lets_few_other_windows_through(spark, stored):
    from bytesift.operators import windowed

    bare = pattern_table(spark, MANY).selectExpr("pattern_id AS _id", "pattern AS _p")
    search = choose(bare, "hash")
    shapes = windowed._shapes(windowed.anchored(bare, search.classes), search)
    other = spark.range(200_000).selectExpr("xxhash64(id, 'x') AS _h").withColumn("mine", F.lit(False))
    windows = other.unionByName(shapes.select("_h").withColumn("mine", F.lit(True)))
    passed = windowed._that_may_meet(windows, shapes, search)
    assert passed.where("mine").count() == shapes.count()
    assert passed.where("NOT mine").count() <= 200_000 / windowed.BITS_PER_ANCHOR * 1.1


def test_filtered_pattern_source_keeps_its_scan_partitions(spark, stored):
    picked = spark.read.parquet(stored).where("text_id < 70").selectExpr("text_id AS pattern_id", "body AS pattern")
    plan = physical(find_matches_multi(spark.read.parquet(stored), picked, "hash"))
    assert "Coalesce 1" not in plan


def test_fresh_folders_are_in_the_checkpoint_folder(spark):
    first, second = fresh_folder(spark, "x"), fresh_folder(spark, "x")
    assert first != second
    named = spark.conf.get("spark.checkpoint.dir")
    assert named in first


def test_few_short_patterns_take_one_window_a_byte(spark):
    for n, expected in ((3, [2]), (20, [3, 2])):
        patterns = [(i, bytearray(b"ab" if i == 0 else b"%03d" % i)) for i in range(n)]
        search = choose(spark.createDataFrame(patterns, "_id INT, _p BINARY"), "hash")
        assert [c.q for c in search.classes] == expected
