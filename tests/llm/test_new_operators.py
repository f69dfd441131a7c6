"""Hard negatives, copied words and periodic runs against brute force."""

import hashlib
import random
import re
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from bytesift.llm import blobs, fmindex, negatives, queries, runs, text

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i * i % 997}" for i in range(6000))
EDGES = [(1, "a b c d e f"), (1, "a b c d e f"), (2, None), (3, ""), (4, " \n\t "), (5, LONG), (6, LONG + " x"),
         (None, LONG), (8, "é ü 漢字 # $ x")]


def table(spark, rows):
    """Documents with clashing extra columns."""
    return spark.createDataFrame(
        [(i, t, 1, "r", 2, 3) for i, t in rows],
        "doc_id BIGINT, text STRING, n INT, runs STRING, shard INT, seeds INT",
    )


def words(t):
    return WORD.findall(t or "")


# --- word hashes


def test_word_hashes_tell_words_apart():
    morse = ["a", "b"]
    while len(morse[0]) < 1024:
        morse = [morse[0] + morse[1], morse[1] + morse[0]]
    many = morse + ["", "x" * 8, "x" * 9, "x" * 511, "x" * 512, "x" * 513, "x" * 5000, "x" * 4999 + "y", "ABCDEFGHIj", "abcdefghij"]
    many += [f"{i:0{w}d}" for w in (3, 9, 17) for i in range(500)]
    found = {}
    for part in text.scan(pa.array(many), lower=False):
        for i in range(len(part)):
            found[many[part.row + i]] = tuple(part.hashes[part.at[i] : part.at[i + 1]].tolist())
    assert len(set(found.values())) == len(set(many))
    low = [w.hashes.tolist() for w in text.scan(pa.array(["ABCDEFGHIj abcdefghij É"]), lower=True)][0]
    assert low[0] == low[1] == found["abcdefghij"][0]
    together = [w.hashes.tolist() for w in text.scan(pa.array([" ".join(m for m in many if m)]), lower=False)][0]
    assert together == [found[m][0] for m in many if m]


def test_bloom_filter_follows_its_members(spark):
    members = 50_000_000
    assert blobs.fits(members) and not blobs.fits(2 * members)
    table = np.zeros(1 << (blobs._log2(members) - 3), dtype=np.uint8)
    for low in range(0, members, 1 << 21):
        blobs.put(table, np.arange(low, min(members, low + (1 << 21)), dtype=np.uint64))
    others = np.arange(members, members + 200_000, dtype=np.uint64)
    assert blobs.may_hold(table, others).mean() < 0.02 and blobs.may_hold(table, others - np.uint64(members)).all()
    small = blobs.bloom(spark.range(1000))
    assert len(small) == 1 << (blobs.LEAST_LOG2 - 3) and blobs.may_hold(small, np.arange(1000, dtype=np.uint64)).all()


# --- 11: hard negatives


def brute_negatives(rows, every):
    known = sorted({
        (i, y, tuple(np.floor(256 * np.array(v, dtype=np.float64)).astype(int).tolist()))
        for i, y, v in rows
        if i is not None and y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    })
    out = []
    for a, y, v in known:
        if a % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, w)), b, z) for b, z, w in known)
        for s, b, _ in [r for r in scored if r[2] == y and r[1] != a][:5]:
            fit = [r for r in scored if r[2] != y and 50 * -s <= 100 * -r[0] <= 95 * -s][:3]
            out += [(a, b, k + 1, r[1], -s, -r[0]) for k, r in enumerate(fit)]
    return sorted(out)


def vectors(seed, n):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(7, 6))
    rows = []
    for i in range(n):
        v = centres[rng.integers(7)] + rng.normal(size=6) * 0.3
        rows.append((i, int(rng.integers(4)), (v * rng.choice([0.01, 1, 3])).tolist()))
    rows += [(n + i, 1, rows[10][2]) for i in range(n // 3)]  # a third has one vector
    rows += [(2 * n, 2, []), (2 * n + 5, 2, [1.0]), (2 * n + 10, 3, [0.0] * 6), (2 * n + 1, None, rows[0][2]), (2 * n + 2, 1, None),
             (2 * n + 3, 1, [1.0, None]), (2 * n + 4, 1, [float("nan")]), (2 * n + 6, 1, [float("inf")]), (None, 1, rows[0][2]),
             (2 * n + 15, 77, rows[3][2])]
    return rows + rows[:20]


COLUMNS_11 = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@pytest.mark.parametrize("sample", [8192, 64, 1])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, sample):
    """Also with a tree fitted on a small part of the rows, and with none."""
    for name, value in (("SAMPLE_ROWS", sample), ("LEAF_ROWS", 20), ("LEAST_SAMPLE", 2), ("WAYS", 3), ("PART_ROWS", 16), ("SEARCHES_TOGETHER", 7)):
        monkeypatch.setattr(negatives, name, value)
    rows = vectors(2, 300)
    docs = spark.createDataFrame([(*r, 1, "s") for r in rows], "vec_id LONG, label INT, embedding ARRAY<FLOAT>, rank INT, q STRING")
    single = [(i, y, v if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, y, v in rows]
    got = negatives.hard_negatives(docs, "vec_id % 5 = 0").collect()
    assert sorted(tuple(r[c] for c in COLUMNS_11) for r in got) == brute_negatives(single, 5)
    assert negatives.hard_negatives(docs.limit(0), "vec_id % 5 = 0").collect() == []


def test_siblings_are_eliminated():
    """On data with clusters most leaves fall out, and no row that fits is in one of them."""
    rng = np.random.default_rng(4)
    rows = np.floor(256 * (rng.normal(size=(40, 8))[rng.integers(40, size=4000)] * 3 + rng.normal(size=(4000, 8)) * 0.1))
    tree = negatives.Tree(float((rows * rows).sum(axis=1).max()))
    tree.grow(rows[:500], 8)
    met = {}
    leaf = tree.place(rows, met)
    for at, (low, high) in met.items():
        tree.nodes[at].low, tree.nodes[at].high = low, high
    anchors = rows[:50]
    scores = anchors @ rows.T
    best = np.sort(scores, axis=1)[:, -6]
    least = np.stack([best, 0.94 * best], axis=1)
    most = np.stack([np.full(50, 1e15), 0.95 * best], axis=1)
    seen = tree.reached(anchors, least, most)
    assert seen.shape[1] == tree.leaves > 20 and seen.mean() < 0.6
    for w in (0, 1):
        a, b = np.nonzero((scores >= least[:, w, None]) & (scores <= most[:, w, None]))
        assert seen[a, leaf[b]].all()


# --- 12: copied words


def brute_copied(rows, size=13):
    least = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - size + 1):
            g = tuple(w[k : k + size])
            if i is not None:
                least[g] = min(i, least.get(g, i))
    out = []
    for i, t in rows:
        w = words(t)
        gone = {x for k in range(len(w) - size + 1) if i is not None and least[tuple(w[k : k + size])] < i for x in range(k, k + size)}
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


def copied_rows(seed, n=60):
    rng = random.Random(seed)
    passages = [[f"p{k}x{j}" for j in range(rng.randint(10, 60))] for k in range(6)]
    rows = []
    for i in range(n):
        w = [f"v{rng.randrange(400)}" for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            w[len(w) // 2 : len(w) // 2] = p[a : a + rng.randint(5, 60)]
        if rng.random() < 0.2:
            w += ["la", "le"] * rng.randint(3, 30)
        rows.append((rng.randrange(2 * n), " ".join(w)))
    return rows + rows[:5] + [(i + 200, t) for i, t in rows[:8]]


@pytest.mark.parametrize("hot, bits", [(1 << 12, 29), (0, 29), (1 << 12, 3)])
def test_copied_words_equal_brute_force(spark, monkeypatch, hot, bits):
    """Also with every seed taken as one of very many documents, and without Bloom filters."""
    monkeypatch.setattr(fmindex, "HOT_DOCUMENTS", hot)
    monkeypatch.setattr(blobs, "MOST_LOG2", bits)
    monkeypatch.setattr(fmindex, "STRETCHES_TOGETHER", 50)
    monkeypatch.setattr(fmindex, "SHARD_WORDS", 1 << 9)
    rows = EDGES + copied_rows(hot)
    got = fmindex.without_copied_words(table(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=repr) == brute_copied(rows)
    assert fmindex.without_copied_words(table(spark, rows).limit(0)).collect() == []


def test_fm_index_counts_and_statistics():
    rng = np.random.default_rng(1)
    numbers = rng.integers(1, 6, 300)
    numbers[-1] = 0
    tree = fmindex.WaveletTree(numbers, 6)
    upto = rng.integers(0, 301, 50)
    for value in range(6):
        assert tree.rank(np.full(50, value), upto).tolist() == [int((numbers[:u] == value).sum()) for u in upto]
    index = fmindex.FmIndex(numbers)
    assert index.order.tolist() == sorted(range(300), key=lambda i: numbers[i:].tolist())
    ends = np.arange(10, 299)
    known, low, high = index.matching_statistics(numbers, ends, 10)
    flat = numbers.tolist()
    for end, k, a, b in zip(ends.tolist(), known.tolist(), low.tolist(), high.tolist()):
        places = [p for p in range(300 - k + 1) if flat[p : p + k] == flat[end - k : end]]
        assert len(places) > 1 and sorted(index.order[a:b].tolist()) == (places if k else sorted(range(300)))
        assert k == 10 or sum(flat[p : p + k + 1] == flat[end - k - 1 : end] for p in range(300 - k)) == 1


# --- 13: periodic runs


def brute_runs(w, least, repeats):
    out = set()
    for q in range(1, len(w) // repeats + 1):
        s = 0
        while s < len(w) - q:
            e = s
            while e < len(w) - q and w[e] == w[e + q]:
                e += 1
            size = e + q - s
            if e > s and size >= least and size >= repeats * q:
                if not any(all(w[x] == w[x + p] for x in range(s, s + size - p)) for p in range(1, q)):
                    out.add((s, size, q))
            s = e + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic_rows(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        w = [f"é{rng.randrange(rng.choice([1, 2, 3, 60]))}" for _ in range(rng.choice([0, 1, 24, 40, 90]))]
        for _ in range(rng.randrange(3)):
            a, p = rng.randrange(len(w) + 1), rng.randint(1, 9)
            b = min(len(w), a + rng.randint(1, 60))
            for k in range(a + p, b):
                w[k] = w[k - p]
        rows.append((i, " \n".join(w)))
    return rows


@pytest.mark.parametrize("least, repeats", [(24, 3), (6, 2), (1, 2), (10, 3), (4, 4)])
def test_runs_equal_brute_force(least, repeats):
    lists = [words(t) for _, t in periodic_rows(least, 120)]
    number = {w: k for k, w in enumerate(sorted({w for x in lists for w in x}))}
    for step in (1, 7):  # documents together and few at a time
        for k in range(0, len(lists), step):
            part = lists[k : k + step]
            got = runs.find_runs([np.array([number[w] for w in x], dtype=np.int64) for x in part], least, repeats)
            assert got == [brute_runs(x, least, repeats) for x in part]


def test_runs_of_long_texts_and_small_pieces(monkeypatch):
    monkeypatch.setattr(runs, "SUFFIXES_TOGETHER", 64)
    assert runs.find_runs([np.arange(50_000) % 5, np.zeros(3000, dtype=np.int64)]) == [[(0, 50_000, 5)], [(0, 3000, 1)]]


def digest(i, t):
    """The contract of op13, word for word."""
    w = words(t)
    h = zlib.crc32(str(i).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    found = brute_runs(w, 24, 3)
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    gone = {x for s, size, q in found for x in range(s + q, s + size)}
    lines = "".join(f"{s},{size},{q}\n" for s, size, q in found)
    kept = " ".join(x for k, x in enumerate(w) if k not in gone)
    return (i, len(found), *best, None if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


COLUMNS_13 = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_run_digests_equal_the_contract(spark):
    rows = [r for r in EDGES if r[0] is not None] + [(i + 100, t) for i, t in periodic_rows(3, 150)]
    got = queries.run_digests(table(spark, rows)).collect()
    assert sorted(tuple(r[c] for c in COLUMNS_13) for r in got) == sorted(digest(i, t) for i, t in rows)
    assert queries.run_digests(table(spark, rows).limit(0)).collect() == []
    assert [r.n_runs for r in queries.run_digests(table(spark, [(None, "a " * 30)])).collect()] == [1]
