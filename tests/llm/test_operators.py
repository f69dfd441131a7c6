"""The training-data operators against brute force, on hand-made tables and sf0.001."""

import hashlib
import re
import subprocess
import sys
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bytesift.llm import chat, fingerprints, html, jaccard, mixing, packing, quality, queries, rules, store, suffixes, toxicity

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i * i % 997}" for i in range(6000))
# nulls, empty and very long texts, ties, repeated rows and ids
EDGES = [(1, "a b c d e f"), (1, "a b c d e f"), (2, None), (3, ""), (4, " \n\t "), (5, LONG), (6, LONG + " x"),
         (None, "a b c d e f"), (7, "A b C d e F"), (8, "é ü 漢字 # $ x")]


def table(spark, rows):
    """Documents with clashing extra columns."""
    return spark.createDataFrame(
        [(i, t, "s", 1, 2, 3) for i, t in rows], "doc_id BIGINT, text STRING, source STRING, n_tokens INT, comp INT, n INT"
    )


def words(text):
    return WORD.findall(text or "")


# --- 1: rules


def counted(text):
    w, seen, covered = words(text), defaultdict(list), set()
    for i in range(len(w) - 7):
        seen[tuple(w[i : i + 8])].append(i)
    for places in seen.values():
        if len(places) > 1:
            for i in places:
                covered.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if words(x)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def test_measures_equal_brute_force(spark):
    repeated = [(20, "a b c d e f g h i a b c d e f g h z"), (21, "x " * 40), (22, "l\nl\n\n \nm\nl"), (23, "a\x0bb\x0cc d")]
    got = rules.judge(table(spark, EDGES + repeated), rules.RULES).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted(tuple(r[n] for n in names) for r in got) == sorted(counted(t) for _, t in EDGES + repeated)
    assert all(not r.kept for r in got if r.base_failed) and all(r.base_failed is not None for r in got)


def test_cascade_order_does_not_change_what_is_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet") if Path(SF).is_dir() else table(spark, EDGES)
    a = {(r.doc_id, r.kept) for r in rules.judge(docs, rules.RULES).collect()}
    assert a == {(r.doc_id, r.kept) for r in rules.judge(docs, rules.RULES[::-1]).collect()}
    assert a == {(r.doc_id, r.kept) for r in rules.judge(docs).collect()}
    made = [rules.Measured(rules.Rule(n, "true"), c, s) for n, c, s in (("a", 2.0, 0.1), ("b", 0.1, 0.1), ("c", 1.0, 0.9))]
    assert [r.name for r in rules.in_order(made)] == ["b", "c", "a"]


def test_rules_are_ordered_by_what_they_add(spark):
    a, b, c = (rules.Rule(n, "true") for n in "abc")
    # b rejects more than c, but only what a has rejected already
    together = {(True, True, False): 50, (True, False, False): 10, (False, False, True): 10, (False, False, False): 30}
    made = rules.greedy([b, a, c], [1.0, 1.0, 1.0], {(y, x, z): n for (x, y, z), n in together.items()})
    assert [(m.rule.name, m.selectivity) for m in made] == [("a", 0.6), ("c", 0.25), ("b", 0.0)]
    assert [m.rule.name for m in rules.greedy([a, b], [9.0, 1.0], {(True, False): 2, (False, True): 1})] == ["b", "a"]
    assert rules.greedy([], [], {}) == []


def test_rules_are_measured_on_rows_that_pass_the_base(spark):
    long = " ".join(f"word{i}" for i in range(40))
    short = [(i, "# # #") for i in range(30)]  # all symbols, but too short to be asked
    docs = table(spark, short + [(100, long), (101, long.upper()), (102, None)])
    got = {m.rule.name: m for m in rules.measure_rules(rules.measures(docs), times=1)}
    assert set(got) == {r.name for r in rules.RULES}
    assert got["symbols"].selectivity == 0 and got["capitals"].selectivity == 0.5
    assert all(m.cost > 0 for m in got.values())
    empty = table(spark, [(1, "a")]).where("false")
    assert all(m.selectivity == 0 for m in rules.measure_rules(rules.measures(empty), times=1))
    assert rules.judge(empty).collect() == []


# --- 2: chat


def test_odd_parts_end_no_job(spark):
    """NULLs, bare values, sizes as texts, unknown and nested parts, and what is no JSON."""
    deep = {"type": "document", "parts": [{"text": "end"}]}
    for _ in range(1200):
        deep = {"type": "document", "parts": [deep]}
    flat = chat.flatten([deep, "after"])
    assert flat.content.endswith("endafter") and len(flat.attachments) == 1201
    assert chat.flatten([None]).content == "" and chat.flatten(None).content == ""
    assert chat.flatten(["hi", None, {"text": None}]).content == "hi"
    image = chat.flatten([{"type": "image", "width": "57", "height": 1, "ref": 7}])
    assert image.expanded_tokens == 3 and image.attachments[0]["ref"] == "7"
    for odd in ("x", [], {}, None, -5, float("nan"), float("inf"), "1e400"):
        assert chat.flatten([{"type": "image", "width": odd, "height": 28}]).expanded_tokens == 0
    listed = [
        None, "", "[null]", '["hi"]', '"hi"', "7", "{not json", '[{"type": ["text"]}]', '[{"type": "_add"}]',
        '[{"text": {"a": 1}}]', '["\\ud800"]', '[{"type": "document", "parts": {"text": "in"}}]',
    ]
    turns = spark.createDataFrame(
        [(1, i, "user", "own", x) for i, x in enumerate(listed)], "conv_id BIGINT, turn INT, role STRING, text STRING, listed STRING"
    )
    got = [r.segment for r in chat.format_turns(turns, "listed").orderBy("turn").collect()]
    contents = [
        "own", "own", "", "hi", "hi", "<unknown:0>", "{not json", "<unknown:0>", "<unknown:0>", '{"a": 1}', "?", "<document:0>in",
    ]
    assert got == [chat.MARKS["user"] + c + chat.END for c in contents]


def test_visitor_flattens_typed_parts_in_order():
    parts = [
        {"type": "text", "text": "see <image:0> \\ #"}, {"type": "image", "ref": "i", "width": 57, "height": 28},
        {"type": "document", "ref": "d", "pages": 2, "parts": [{"type": "text", "text": "in"}, {"type": "audio", "ref": "a", "seconds": 1.5}]},
        {"type": "new", "ref": "u"}, {},
    ]
    flat = chat.flatten(parts)
    assert [(a["kind"], a["ref"], a["tokens"]) for a in flat.attachments] == [
        ("image", "i", 3), ("document", "d", 1024), ("audio", "a", 38), ("unknown", "u", 0)
    ]
    assert flat.expanded_tokens == 1065
    for n, a in enumerate(flat.attachments):
        assert flat.content[a["at"] :].startswith(f"<{a['kind']}:{n}>")
    assert flat.content.startswith("see \\<image:0> \\\\ \\#")


def test_chat_round_trip(spark):
    said = [(1, 1, "assistant", "b\n### User: <x>"), (1, 0, "user", None), (2, 0, None, "t"), (2, 0, "tool: \\", "</turn>\n"),
            (None, 0, "assistant", "\\"), (3, None, "user", "")]
    turns = spark.createDataFrame(said, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    segments = chat.format_turns(turns)
    back = {(r.conv_id, r.turn, *chat.read_segment(r.segment)[:2]) for r in segments.collect()}
    assert {(c, t, r, chat.unescape(x)) for c, t, r, x in back} == {(c, t, r or "", x or "") for c, t, r, x in said}
    got = {r.conv_id: r for r in chat.digests(segments).collect()}
    assert got[1].turns_sha256 == hashlib.sha256(b"user\n\nassistant\nb\n### User: <x>\n").hexdigest()
    assert got[1].loss_sha256 == hashlib.sha256(b"b\n### User: <x>").hexdigest() and got[2].n_turns == 2
    assert chat.digests(segments.limit(0)).collect() == []


# --- 3 and 7: mixing and packing


def test_targets_are_capped_and_shared_again():
    assert mixing.targets([10, 100, 0], [5, 2, 1], 60, 2) == [20, 40, 0]
    assert mixing.targets([], [], 0, 2) == []


def test_permutation_hits_each_index_once():
    for n in (1, 2, 3, 17, 1000):
        got = mixing.permuted(np.arange(n), np.full(n, n), np.full(n, 5, np.uint64))
        assert sorted(got) == list(range(n))


def test_mix_keeps_to_targets_and_reruns_agree(spark):
    rows = [(i, " ".join(f"v{i}x{k}" for k in range(i % 90))) for i in range(400)]
    docs = spark.createDataFrame([(i, t, [None, "a", "b"][i % 3]) for i, t in rows], "doc_id LONG, text STRING, source STRING")
    mixed = mixing.mix(docs)
    got = sorted(mixing.taken(mixed).collect())
    assert got == sorted(mixing.taken(mixing.mix(docs)).collect())
    assert [r["size"] for r in got] == [len(words(t)) for _, t in rows]
    assert all(r.taken <= 2 * r["size"] for r in got)
    for share in mixed.shares:
        mine = [r for r in got if r.target == share.target]
        assert abs(sum(r.taken for r in mine) - share.target) <= 0.03 * share.target
    out = mixing.mixed_documents(docs, mixed).collect()
    assert sum(len(words(r.text)) for r in out) == sum(r.taken for r in got)
    whole = dict(rows)
    assert all(r.text in whole[r.doc_id] for r in out)
    assert mixing.taken(mixing.mix(docs.limit(0))).collect() == []


def test_boundaries_are_optimal():
    import itertools

    lengths, counts = np.array([1, 3, 4, 9, 10]), np.array([5, 1, 7, 2, 3])

    def padded(edges):
        return sum(c * min(e for e in edges if e >= n) for n, c in zip(lengths, counts))

    for k in (1, 2, 3, 5):
        best = min(padded([*e, 10]) for r in range(k) for e in itertools.combinations(lengths[:-1], r))
        assert padded(packing.boundaries(lengths, counts, k)) == best
    assert packing.boundaries(np.array([]), np.array([]), 3) == []


def test_every_row_is_packed_within_the_budget(spark):
    docs = table(spark, EDGES).withColumn("many", F.lit(1))
    packed, edges = packing.pack(docs, packing.word_count(), F.col("doc_id"), buckets=3, budget=20)
    got = packed.collect()
    assert sorted(r.n_tokens for r in got) == sorted(len(words(t)) for _, t in EDGES) and len(edges) == 3
    by = defaultdict(list)
    for r in got:
        assert r.n_tokens <= r.bucket_tokens and r.padding == r.bucket_tokens - r.n_tokens
        by[r.bucket, r.batch].append(r)
    assert all(len(v) == 1 or len(v) * v[0].bucket_tokens <= 20 for v in by.values())
    assert packing.pack(docs.limit(0), packing.word_count(), F.col("doc_id"))[0].collect() == []


# --- 4, 6 and 10: copies


def sets(text):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words(text)]
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def components(rows):
    found, root = {i: sets(t) for i, t in rows if i is not None}, {}
    root = {i: i for i in found}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in found:
        for b in found:
            both = len(found[a] & found[b])
            if a < b and both and 100 * both >= 80 * len(found[a] | found[b]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(found[i]), top(i)) for i in found}


def near_copies(n=60):
    """Chains and stars of near copies, and many that share a passage only."""
    base = [f"b{i}" for i in range(60)]
    out = []
    for i in range(n):
        w = list(base)
        for k in range(i % 5):
            w[(i * 7 + k * 11) % 60] = f"e{i}x{k}"
        out.append((100 + i, " ".join(w)))
    return out + [(300 + i, " ".join(base[:30] + [f"u{i}x{k}" for k in range(40)])) for i in range(n)]


def test_components_equal_brute_force(spark):
    rows = EDGES + near_copies()
    got = jaccard.similar_documents(table(spark, rows)).collect()
    expected = components(rows)
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id is None if r.doc_id is None else (r.n_shingles, r.component_id) == expected[r.doc_id]
    assert jaccard.similar_documents(table(spark, rows).limit(0)).collect() == []


def test_banded_signatures_find_the_same_components(spark):
    rows = near_copies()
    got = {r.doc_id: r.component_id for r in fingerprints.similar(table(spark, rows)).collect()}
    assert got == {i: c for i, (_, c) in components(rows).items()}


def test_fingerprints_and_edited_texts(spark):
    rows = [(i, t) for i, t in EDGES if i not in (None, 1)] + [(0, "one")] + near_copies(5)
    got = {r.doc_id: r for r in fingerprints.fingerprints(table(spark, rows)).collect()}
    order = sorted(rows)
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        edited = text[: len(text) - len(text) // 4] + after[: len(text) // 4]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[i].n_chars == len(text)
        a, b = sets(text), sets(edited)
        assert abs(got[i].near_edited - (len(a & b) / len(a | b) if a | b else 1.0)) < 0.2
    assert got[2].fingerprint == got[3].fingerprint == got[4].fingerprint == ""
    assert fingerprints.fingerprints(table(spark, rows).limit(0)).collect() == []


def brute_spans(rows, size):
    at = {i: [(m.start(), m.end(), m.group()) for m in WORD.finditer(t or "")] for i, t in rows if i is not None}
    places = defaultdict(list)
    for i, w in at.items():
        for k in range(len(w) - size + 1):
            places[tuple(x[2] for x in w[k : k + size])].append((i, k))
    again = defaultdict(dict)
    for found in places.values():
        if len(found) > 1:
            for i, k in found:
                again[i][k] = (i, k) != min(found)
    out = set()
    for i, ks in again.items():
        runs = []
        for k in sorted(ks):
            if runs and k - runs[-1][-1] <= size:
                runs[-1].append(k)
            else:
                runs.append([k])
        for run in runs:
            dropped = {w for k in run if ks[k] for w in range(k, k + size)}
            out.add((i, run[0], run[-1] + size - run[0], at[i][run[0]][0], at[i][run[-1] + size - 1][1], len(dropped)))
    return out


def test_spans_equal_brute_force_and_are_cut(spark):
    passage = " ".join(f"é{i}" for i in range(70))
    rows = [(1, f"start {passage} end"), (2, f"{passage}\n\nother words " + passage[:200]), (3, "a " * 130), (4, None),
            (5, LONG), (6, f"x {LONG}"), (7, "short"), (9, LONG)]
    names = ("doc_id", "start_word", "n_words", "start_char", "end_char", "n_dropped")
    got = {tuple(r[n] for n in names) for r in suffixes.repeated_spans(table(spark, rows)).collect()}
    assert got == brute_spans(rows, 50)
    left = {r.doc_id: r.text for r in suffixes.without_repeats(table(spark, rows)).collect()}
    assert left[1] == rows[0][1] and left[7] == "short" and left[4] is None and 9 not in left and left[6] == "x "
    assert left[2].strip().startswith("other words")
    assert suffixes.repeated_spans(table(spark, rows).limit(0)).collect() == []


@pytest.mark.parametrize("hot_places", [1 << 12, 1])
def test_sorted_suffixes_equal_brute_force(spark, monkeypatch, hot_places):
    """Few words, so that matches hide each other, also words that begin like others."""
    monkeypatch.setattr(suffixes, "HOT_PLACES", hot_places)
    rng = np.random.default_rng(11)
    known = np.array(["a", "ab", "a\x01", "a!", "é"])
    rows = []
    for i in range(60):
        w = rng.choice(known, int(rng.integers(0, 90)), p=[0.4, 0.3, 0.1, 0.1, 0.1])
        rows.append((i, "\t".join(w) if i % 2 else "  ".join(w)))
        if i % 7 == 6:  # near copies, and a text whose first half is of one and its second of another
            rows.append((100 + i, rows[-1][1].replace("é", "a", 1)))
            rows.append((200 + i, " ".join(words(rows[-1][1])[:40] + words(rows[-4][1])[5:])))
    names = ("doc_id", "start_word", "n_words", "start_char", "end_char", "n_dropped")
    for size, seed in ((9, 3), (6, 6), (20, 4)):
        found = suffixes.repeated_spans(table(spark, rows), size=size, seed=seed).collect()
        got = [tuple(r[n] for n in names) for r in found]
        assert len(set(got)) == len(got) and set(got) == brute_spans(rows, size)
        texts = dict(rows)
        for r in found:
            assert sum(len(words(texts[r.doc_id][d.low : d.high])) for d in r.drops) == r.n_dropped


@pytest.mark.parametrize("block", [4, 1 << 15])
def test_hot_seeds_make_ranges_not_rows_per_stretch(spark, monkeypatch, block):
    """A passage of very many texts, and a pair of words said again and again, where each
    place has two stretches: ranges go on over suffixes, in blocks of any size."""
    monkeypatch.setattr(suffixes, "HOT_PLACES", 3)
    monkeypatch.setattr(suffixes, "BLOCK", block, raising=False)
    made, counted = [], suffixes._counted_stretches

    def seen(hot, most):
        made.append((hot, counted(hot, most)))
        return made[-1][1]

    monkeypatch.setattr(suffixes, "_counted_stretches", seen)
    passage = " ".join(f"é{i}" for i in range(160))
    rows = [(i, f"before{i} {passage} " + " ".join(f"w{i}x{j}" for j in range(i % 5 * 20))) for i in range(40)]
    rows += [(100 + i, f"{passage} x{i} {passage}") for i in range(3)]
    rows += [(200 + i, f"{i}a {i}b " + "to and " * (60 + 40 * i)) for i in range(3)]
    names = ("doc_id", "start_word", "n_words", "start_char", "end_char", "n_dropped")
    got = [tuple(r[n] for n in names) for r in suffixes.repeated_spans(table(spark, rows)).collect()]
    assert len(set(got)) == len(got) and set(got) == brute_spans(rows, 50)
    ((hot, ranges),) = made
    n_hot = hot.count()
    assert 49 <= ranges.count() <= (3 * 49 if block > n_hot else n_hot) and n_hot < 46 * 111 / 4
    assert "explode" not in ranges._jdf.queryExecution().executedPlan().toString()


def test_a_third_text_hides_no_match():
    """Between two texts that match to the left stands one that matches further to the right."""
    numbers = [[1, 2, 3, 4, 5, 9], [1, 2, 3, 4, 6, 9], [1, 2, 3, 4, 6, 8]]
    after = np.array([x[2:] for x in numbers], dtype=np.int32)  # sorted
    before = np.array([[2, 1], [7, 1], [2, 1]], dtype=np.int32)
    state = suffixes.matched_stretches(
        np.zeros(3, dtype=np.int64), np.array([5, 2, 1]), np.ones(3, dtype=np.int64), before, np.array([2, 2, 2]), after, np.array([4, 4, 4]), 4
    )
    assert state.tolist() == [[0, 0, 1], [0, 0, 0], [0, 0, 2]]


# --- 5 and 8: models


def toy(n=240):
    rng = np.random.default_rng(3)
    normal = [f"{a}{b}" for a in ("ra", "to", "mi", "lu") for b in ("ven", "sok", "pim", "dar")]
    rows = []
    for i in range(n):
        w = list(rng.choice(normal, 30))
        if i % 3 == 0:
            w[::6] = [["grumbolt", "grumbollt", "grumb0lt"][i % 9 // 3]] * 5
        rows.append((i, " ".join(w), int(i % 3 == 0)))
    return rows


@pytest.mark.parametrize("column", ["toxic", "quality"])
def test_models_learn_and_take_unseen_misspellings(spark, column):
    rows = toy()
    docs = table(spark, [(i, t) for i, t, _ in rows] + [(900, "raven grumboltt tosok grumbolt"), (901, None), (902, "")])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5, None)], f"doc_id LONG, {column} INT")
    if column == "toxic":
        got = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    else:
        vectors = quality.word_vectors(docs)
        got = quality.score(docs, vectors, quality.fit(docs, labels, vectors, column)).collect()
    by = {r.doc_id: r for r in got}
    aside = [(by[i].predicted, y) for i, _, y in rows if by[i].held_out]
    assert sum(p == y for p, y in aside) >= 0.9 * len(aside) and len(aside) > 20
    assert by[901].score == by[902].score and all(0 <= r.score <= 1 for r in got)
    if column == "toxic":
        assert by[900].predicted == 1
        assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), labels)).collect() == []


def test_bucket_ends_at_its_longest_document(spark):
    docs = spark.createDataFrame([(i, n) for i, n in enumerate([3, 1027, 2049, 5001, 70_001])], "doc_id LONG, words LONG")
    packed, edges = packing.pack(docs, F.col("words"), F.col("doc_id"))
    assert edges == [3, 1027, 2049, 5001, 70_001]
    assert all(r.padding == 0 for r in packed.collect())


# --- 9: pages


def test_main_text(spark):
    page = (
        '<html><head><title>T</title></head><body><nav><a>menu</a></nav><div class="cookie-notice">yes</div><article><h1>A &amp; B</h1>'
        "<p>one\n  <b>two</b><br>x<p>three&nbsp;<script>if(a<b){}</script>four<ul><li>l1<li>l2</ul><div class=ads>buy</div>"
        '<section class="comments"><p>me too</p></section></article><footer>f</footer>'
    )
    plain = "<body><div><p>same line</p><p>own {} text</p></div></body>"
    rows = [(1, "http://a/1", page), (2, "http://a/2", None), (3, None, "")] + [(10 + i, f"http://p.q/{i}", plain.format(i)) for i in range(4)]
    got = {r.page_id: r for r in html.main_text(spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING")).collect()}
    assert got[1].text == "A & B\n\none two x\n\nthree four\n\nl1\n\nl2" and got[1].n_chars == len(got[1].text)
    assert got[2].text == got[3].text == "" and got[11].text == "own 1 text"


def test_main_text_by_slots(spark):
    """The main region of each layout follows from its slots, not from names around it."""
    def layout(k, i):
        own = f"{k}{i} " + " ".join(f"w{i}x{k}y{j}" for j in range(30))
        notice = '<p class="notice">n</p>' if i == 0 else ""  # not of the template, so its name says nothing
        return (
            f'<body class="b{k}"><div class="layout has-sidebar"><div class="l{k}"><a>menu</a><a>of {i}</a></div><div id="header-fix" class="m{k}"><h1>T{i}</h1>'
            f'<p>Read this first</p><p>{own}</p>{notice}<div class="comments">c{i}</div></div></div><div class="z">f{i}</div></body>',
            f"T{i}\n\n{own}" + ("\n\nn" if notice else ""),
        )

    rows, expected = [], {}
    for k in range(5):  # each layout has less than a third of the host's pages
        for i in range(4):
            page, expected[10 * k + i] = layout(k, i)
            rows.append((10 * k + i, f"http://a.b/{k}/{i}", page))
    words = " ".join(f"v{j}" for j in range(30))
    rows += [(200, "http://c.d/", f'<div class="layout has-sidebar"><article>{words}</article><div class="ad">ad</div></div>')]
    rows += [(201, "http://d.e/", f'<div class="layout has-sidebar"><p>{words}</p></div><div class="sidebar">x</div>')]
    # near copies are no template: their text stays
    rows += [(300 + i, "http://e.f/", f'<body><div class="s">s</div><article><p>{words}</p><p>c{i}</p></article></body>') for i in range(3)]
    expected |= {200: words, 201: words} | {300 + i: f"{words}\n\nc{i}" for i in range(3)}
    got = html.main_text(spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING")).collect()
    assert {r.page_id: r.text for r in got} == expected


def test_what_articles_share_stays(spark):
    """Headings, separators and named paragraphs that all pages of a host have in their article."""
    def article(i):
        own = " ".join(f"w{i}x{j}" for j in range(20))
        return f"<h1>T{i}</h1><h2>Summary</h2><p>{own}</p><p>* * *</p><h2>References</h2><p>r{i}</p>", f"T{i}\n\nSummary\n\n{own}\n\n* * *\n\nReferences\n\nr{i}"

    rows = [(i, "http://a.b/", f"<body><nav>menu</nav><article>{article(i)[0]}</article><footer>f</footer></body>") for i in range(6)]
    rows += [(10 + i, "http://c.d/", f'<body><div class="top">menu</div><div class="x">{article(i)[0]}</div></body>') for i in range(6)]
    got = {r.page_id: r.text for r in html.main_text(spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING")).collect()}
    assert all(got[i] == article(i)[1] for i in range(6))
    assert all("Summary" in got[10 + i] and "References" in got[10 + i] and "menu" not in got[10 + i] for i in range(6))


def test_pages_that_close_nothing_take_linear_time():
    import time

    def seconds(n):
        began = time.process_time()
        page = html.Page("<div><font>row" * n)
        assert html._by_names(page) == ["row"] * n and max(len(page.above(e)) for e in range(len(page.tokens))) <= html.DEPTH
        return time.process_time() - began

    seconds(100)
    assert seconds(8000) < 1
    assert html._by_names(html.Page("<div>" * 300 + "<div hidden>" + "<div>" * 300 + "gone")) == []


def test_attributes_and_formulas(spark):
    page = (
        """<article><p title="the hidden cost">a</p><section aria-label="Hidden history">b</section><p data-id="comment">c</p><p data-class='ad'>d</p>"""
        """<p id=x'y>e</p><p title="a > b">f'</p><p>x <math><mi>n</mi><mo>=</mo><mn>2</mn></math> y</p>"""
        """<p hidden>-</p><p HIDDEN=''>-</p><p class=ad>-</p><p\nstyle = "color:red; display : none">-</p><p aria-hidden='true'>-</p></article>"""
    )
    row = html.main_text(spark.createDataFrame([(1, "http://a/", page)], "page_id LONG, url STRING, html STRING")).first()
    assert row.text == "a\n\nb\n\nc\n\nd\n\ne\n\nf'\n\nx n=2 y"


def test_bytes_of_sliced_columns():
    column = pa.array(["a", None, "bb c", ""]).slice(1)
    assert [len(s) for s in jaccard._sets(column, 5)] == [0, 1, 0]


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_each_query_returns_its_rows(spark, name):
    df = queries.QUERIES[name](spark, SF)
    rows = df.count()
    expected = {"op2_chat": "conversations", "op9_html": "pages"}.get(name, "documents")
    source = spark.read.parquet(f"{SF}/{expected}.parquet")
    if name == "op2_chat":
        assert rows == source.select("conv_id").distinct().count() + 1
    elif name not in ("op10_repeats", "op11_negatives"):
        assert rows == source.count()


@needs_tables
def test_pipeline_stages_hand_on_documents(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before, columns = docs.count(), docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert 0 < docs.select("doc_id").distinct().count() < before
    assert "doc_id" in corpus_pipeline.STAGES[-1][1](spark, docs, SF).columns


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = queries.QUERIES[name](spark, SF)
    expected = con.execute(queries.ORACLES[name]).fetchall()
    names = [d[0] for d in con.description]
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r[n] for n in names)) for r in df.collect())


# --- memory of the workers


def test_sorted_suffixes_are_compared_some_at_once():
    read = 0

    def sorted_suffixes():
        nonlocal read
        words = " ".join(f"w{i}" for i in range(60)).encode() + b" "
        lists = pa.array([[0]] * 1000, pa.list_(pa.int32()))
        for low in range(0, 30_000, 1000):
            read += 1000
            each = np.arange(low, low + 1000)
            # pairs of equal suffixes, each pair with a seed of its own
            columns = [each, each // 2, *[np.zeros(1000, np.int32)] * 2, [b""] * 1000, [words] * 1000, lists, lists, np.ones(1000, np.int64)]
            names = ["doc_id", "key", "pos", "low_pos", "before", "after", "lows", "highs", "copies"]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)

    found, most, before = 0, 0, 0
    for ranges in suffixes._compare(50, 10)(sorted_suffixes()):
        most, before = max(most, read - before), read
        found += len(ranges)
    assert found == 30_000 and most < 12_000


def test_small_tables_start_no_python_rdd(spark):
    docs = spark.range(9).selectExpr("id AS doc_id", "concat('text ', id) AS text", "'s' AS source")
    mixed = mixing.mix(docs)
    for made in (packing.pack(docs, packing.word_count(), F.col("doc_id"))[0], mixing.taken(mixed)):
        assert "ExistingRDD" not in made._jdf.queryExecution().toString()
    got = store.small_table(spark, a=pa.array(["x", None], pa.string()), b=pa.array([1, 2], pa.int32()))
    assert got.dtypes == [("a", "string"), ("b", "int")] and sorted(got.collect(), key=str) == [("x", 1), (None, 2)]
    assert store.small_table(spark, a=pa.array([], pa.int64())).collect() == []


def test_workers_load_no_pandas():
    code = "import sys, bytesift.llm.mixing, corpus_pipeline; print('pandas' in sys.modules)"
    root = Path(__file__).resolve().parents[2]
    said = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    assert said.stdout.strip() == "False"


def test_accepted_keeps_all_batches(spark):
    docs = spark.range(2000).coalesce(1).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    model = toxicity.Model(np.zeros(1 << toxicity.BUCKETS_LOG2, np.float32), -1.0)
    kept = toxicity.accepted(docs, model)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(2000))
