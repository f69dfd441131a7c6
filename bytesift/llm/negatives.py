"""Hard negatives: rows of another label that score just below an anchor's positives.

The index is a geometric near-neighbour access tree.  A node has a few split points;
a row goes to the child of the nearest one, so cells are bounded by hyperplanes.  For
every split point i and sibling j the node keeps the least and the greatest distance
from i to the rows of j.  A search for scores between two bounds is a search for rows
between two spheres around the anchor: a sibling falls out as soon as its range of
distances from one split point cannot meet that annulus.  Leaves are searched exactly.

Scores are inner products, distances need a metric: each row gets one more component
that brings all rows to the norm of the longest, the anchor gets 0 there.  Then
distance^2 = |anchor|^2 + longest^2 - 2 score, and bounds of scores are radii.

Split points are fitted on a bounded sample of rows; ranges of distances and leaves are
of all rows.  Rows of equal vector and label are one entry with its smallest ids, as
many as can ever be wanted.  A leaf is dealt in parts of bounded size, and the searches
that reach a part are streamed past it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bytesift.llm.store import stored

POSITIVES = 5
NEGATIVES = 3
# Bounds of a negative's score, in hundredths of the positive's.
LOW, HIGH = 50, 95
SCALE = 256

# Bounds of the index, whatever the table: rows of the sample, split points of a node,
# rows that a leaf is meant to hold, sample rows that a leaf has at least.
SAMPLE_ROWS = 8192
WAYS = 8
LEAF_ROWS = 2048
LEAST_SAMPLE = 8
# Rows of one part of a leaf, and searches multiplied with it at once.
PART_ROWS = 4096
SEARCHES_TOGETHER = 512
# Whole numbers up to here are exact in the products.
EXACT = 2**53


@dataclass
class Node:
    points: np.ndarray  # split points, one per child
    children: list[int]  # another node, or -1 - leaf
    low: np.ndarray = field(default=None)  # distances from point i to the rows of child j
    high: np.ndarray = field(default=None)


def distances(rows: np.ndarray, points: np.ndarray, longest: float) -> np.ndarray:
    """Between rows and points, both brought to the norm ``longest``."""
    filled = [np.sqrt(np.maximum(longest - (x * x).sum(axis=1), 0)) for x in (rows, points)]
    product = rows @ points.T + filled[0][:, None] * filled[1][None, :]
    return np.sqrt(np.maximum(2 * (longest - product), 0))


@dataclass
class Tree:
    """``longest`` is the greatest squared norm of all rows."""

    longest: float
    nodes: list[Node] = field(default_factory=list)
    leaves: int = 0

    def grow(self, sample: np.ndarray, leaf_rows: int) -> int:
        """A node over ``sample``, or a leaf; returns it as a child number."""
        first = self._spread(sample) if len(sample) > max(leaf_rows, 1) else []
        if len(first) < 2:
            self.leaves += 1
            return -self.leaves
        node, at = Node(sample[first], []), len(self.nodes)
        self.nodes.append(node)
        nearest = distances(sample, node.points, self.longest).argmin(axis=1)
        node.children = [self.grow(sample[nearest == j], leaf_rows) for j in range(len(first))]
        return at

    def _spread(self, sample: np.ndarray) -> list[int]:
        """Up to WAYS rows, each the farthest from those before."""
        chosen = [0]
        gap = distances(sample, sample[:1], self.longest)[:, 0]
        while len(chosen) < WAYS and gap.max() > 1e-5 * np.sqrt(self.longest):
            chosen.append(int(gap.argmax()))
            gap = np.minimum(gap, distances(sample, sample[chosen[-1:]], self.longest)[:, 0])
        return chosen

    def place(self, rows: np.ndarray, met: dict[int, tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The leaf of each row; ``met`` takes the ranges of distances at each node."""
        out = np.zeros(len(rows), dtype=np.int64)
        todo = [(0, np.arange(len(rows)))] if self.nodes else []
        while todo:
            at, mine = todo.pop()
            node = self.nodes[at]
            apart = distances(rows[mine], node.points, self.longest)
            nearest = apart.argmin(axis=1)
            k = len(node.children)
            low, high = met.setdefault(at, (np.full((k, k), np.inf), np.full((k, k), -np.inf)))
            for j, child in enumerate(node.children):
                these = nearest == j
                if these.any():
                    low[:, j] = np.minimum(low[:, j], apart[these].min(axis=0))
                    high[:, j] = np.maximum(high[:, j], apart[these].max(axis=0))
                    if child >= 0:
                        todo.append((child, mine[these]))
                    else:
                        out[mine[these]] = -1 - child
        return out

    def reached(self, anchors: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Which leaves (columns) each anchor (row) has to look at for rows that score
        between ``least`` and ``most``, several windows (columns of both) together."""
        out = np.zeros((len(anchors), max(1, self.leaves)), dtype=bool)
        if not self.nodes:
            out[:] = (least <= most).any(axis=1)[:, None]
            return out
        norms = (anchors * anchors).sum(axis=1)
        slack = 1e-5 * np.sqrt(max(self.longest, 1)) + 1e-9 * np.sqrt(norms)[:, None]
        square = norms[:, None] + self.longest
        inner = np.sqrt(np.maximum(square - 2 * most, 0)) - slack
        outer = np.sqrt(np.maximum(square - 2 * least, 0)) + slack
        todo = [(0, np.arange(len(anchors)), (least <= most) & (square - 2 * least >= -slack))]
        while todo:
            at, mine, alive = todo.pop()
            node = self.nodes[at]
            # from an anchor, which has 0 in the added component, to a split point
            apart = norms[mine, None] + self.longest - 2 * anchors[mine] @ node.points.T
            apart = np.sqrt(np.maximum(apart, 0))
            for j, child in enumerate(node.children):
                far = (apart + node.high[:, j]).min(axis=1)
                near = np.maximum(apart - node.high[:, j], node.low[:, j] - apart).max(axis=1)
                meets = alive & (inner[mine] <= far[:, None]) & (outer[mine] >= near[:, None])
                some = meets.any(axis=1)
                if some.any():
                    if child >= 0:
                        todo.append((child, mine[some], meets[some]))
                    else:
                        out[mine[some], -1 - child] = True
        return out


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of 32-bit numbers as float64; shorter ones are filled with zeros."""
    cells = [np.frombuffer(x.as_buffer(), dtype="<i4") for x in column]
    out = np.zeros((len(cells), width))
    for row, cell in zip(out, cells):
        row[: len(cell)] = cell
    return out


def prepared(rows: DataFrame, scale: int) -> DataFrame:
    """vec_id, label, q (whole components as bytes) and norm (squared) of the rows that
    take part: no NULL in vec_id, label or vector, all components finite."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels, qs, norms = [], [], [], []
            for doc, label, vector in zip(batch["vec_id"].to_pylist(), batch["label"].to_pylist(), batch["embedding"]):
                values = vector.values
                if values.null_count:
                    continue
                x = values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(x).all():
                    continue
                x = np.floor(scale * x)
                norm = float(x @ x)
                if norm >= EXACT:
                    raise ValueError(f"the vector of {doc} is too long for exact scores")
                ids.append(doc)
                labels.append(label)
                qs.append(x.astype("<i4").tobytes())
                norms.append(norm)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(labels, pa.int64()), pa.array(qs, pa.binary()), pa.array(norms, pa.float64())],
                ["vec_id", "label", "q", "norm"],
            )

    some = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>"))
    some = some.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    return some.mapInArrow(read, "vec_id BIGINT, label BIGINT, q BINARY, norm DOUBLE")


def index(entries: DataFrame, longest: float, width: int) -> tuple[DataFrame, Tree, dict, dict[int, int]]:
    """The entries (label, q, ids) with their leaf, the tree, its sample (matrix and
    labels), and the number of rows in each leaf."""
    total = entries.count()
    sample = entries.orderBy(F.xxhash64("q", "label")).limit(SAMPLE_ROWS).select("label", "q").toArrow()
    vectors = matrix(sample["q"].combine_chunks(), width)
    tree = Tree(longest)
    tree.grow(vectors, max(LEAST_SAMPLE, LEAF_ROWS * len(vectors) // max(1, total)))
    shared = entries.sparkSession.sparkContext.broadcast(tree)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            leaf = shared.value.place(matrix(batch["q"], width), met)
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaf, pa.int32()), batch["label"], batch["q"], batch["ids"], pa.nulls(len(batch), pa.int32()),
                 pa.nulls(len(batch), pa.list_(pa.float64())), pa.nulls(len(batch), pa.list_(pa.float64()))], names,
            )
        some, ranges = list(met), list(met.values())
        flat = [pa.array([r[k].reshape(-1).tolist() for r in ranges], pa.list_(pa.float64())) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(some), pa.int32()), pa.nulls(len(some), pa.int64()), pa.nulls(len(some), pa.binary()),
             pa.nulls(len(some), pa.list_(pa.int64())), pa.array(some, pa.int32()), *flat], names,
        )

    names = ["leaf", "label", "q", "ids", "node", "low", "high"]
    both = stored(
        entries.select("label", "q", "ids").mapInArrow(
            assign, "leaf INT, label BIGINT, q BINARY, ids ARRAY<BIGINT>, node INT, low ARRAY<DOUBLE>, high ARRAY<DOUBLE>"
        ),
        "leaves",
    )
    # one row per node and cell of its table: as many as the tree has, not the rows
    cells = both.where("node IS NOT NULL").select("node", F.posexplode(F.arrays_zip("low", "high")).alias("at", "of"))
    cells = cells.groupBy("node", "at").agg(F.min("of.low").alias("low"), F.max("of.high").alias("high"))
    for node in tree.nodes:
        k = len(node.children)
        node.low, node.high = np.full((k, k), np.inf), np.full((k, k), -np.inf)
    for r in cells.collect():
        node = tree.nodes[r["node"]]
        node.low.flat[r["at"]], node.high.flat[r["at"]] = r["low"], r["high"]
    rows = both.where("leaf IS NOT NULL").select("leaf", "label", "q", "ids")
    held = {r["leaf"]: r["count"] for r in rows.groupBy("leaf").count().collect()}
    shared.destroy()
    return rows, tree, {"vectors": vectors, "labels": sample["label"].to_numpy()}, held


def _best(of: np.ndarray, score: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """The places of the k highest scores of each group ``of``, ties by ``first``."""
    by = np.lexsort((first, -score, of))
    new = np.ones(len(by), dtype=bool)
    new[1:] = np.diff(of[by]) != 0
    starts = np.flatnonzero(new)
    rank = np.arange(len(by)) - np.repeat(starts, np.diff(np.append(starts, len(by))))
    return by[rank < k]


def search(
    entries: DataFrame, tree: Tree, sample: dict, held: dict[int, int], asked: DataFrame, width: int, same: bool, k: int
) -> DataFrame:
    """aid, window, score and ids of the entries that may be among the best ``k`` of
    each window of each search.

    ``asked(aid, label, q, least, most)`` has arrays of the lowest and highest scores
    wanted.  ``same`` tells whether entries of the search's own label are looked for, or
    those of others.  The k best of the sample raise the lower bounds first.
    """
    context = asked.sparkSession.sparkContext
    shared = context.broadcast((tree, sample))
    parts = {leaf: -(-n // PART_ROWS) for leaf, n in held.items()}
    base, total = {}, 0
    for leaf in sorted(parts):
        base[leaf] = total
        total += parts[leaf]
    spots = context.broadcast((base, parts))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (tree, sample), (base, parts) = shared.value, spots.value
        for whole in batches:
            for at in range(0, len(whole), SEARCHES_TOGETHER):
                batch = whole.slice(at, SEARCHES_TOGETHER)
                anchors, labels = matrix(batch["q"], width), batch["label"].to_numpy()
                least, most = (np.array(batch[c].to_pylist(), dtype=object) for c in ("least", "most"))
                windows = max((len(x) for x in least), default=0)
                low, high = np.full((len(batch), windows), np.inf), np.full((len(batch), windows), -np.inf)
                for row in range(len(batch)):
                    low[row, : len(least[row])], high[row, : len(most[row])] = least[row], most[row]
                scores = anchors @ sample["vectors"].T
                wanted = (labels[:, None] == sample["labels"][None, :]) == same
                for w in range(windows if scores.shape[1] >= k else 0):
                    inside = np.where(wanted & (scores >= low[:, w, None]) & (scores <= high[:, w, None]), scores, -np.inf)
                    kth = np.partition(inside, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
                    low[:, w] = np.maximum(low[:, w], kth)
                rows, leaves = np.nonzero(tree.reached(anchors, low, high))
                spot = [[base[x] + p for p in range(parts[x])] if x in parts else [] for x in leaves.tolist()]
                of = np.repeat(rows, [len(s) for s in spot])
                taken = batch.take(pa.array(of, pa.int64()))
                bounds = [pa.array(list(b[of]), pa.list_(pa.float64())) for b in (low, high)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p for s in spot for p in s], pa.int32()), pa.array(np.ones(len(of), dtype=np.int8)), taken["aid"],
                     taken["label"], taken["q"], pa.nulls(len(of), pa.list_(pa.int64())), *bounds], names,
                )

    names = ["part", "kind", "aid", "label", "q", "ids", "least", "most"]
    schema = "part INT, kind TINYINT, aid BINARY, label BIGINT, q BINARY, ids ARRAY<BIGINT>, least ARRAY<DOUBLE>, most ARRAY<DOUBLE>"
    routed = asked.select("aid", "label", "q", F.col("least").cast("array<double>"), F.col("most").cast("array<double>"))
    routed = routed.mapInArrow(route, schema)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, parts = spots.value
        for batch in batches:
            n = len(batch)
            leaf = batch["leaf"].to_numpy()
            first = np.array([x.values[0].as_py() for x in batch["ids"]], dtype=np.int64)
            mixed = (first.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
            spot = [base[x] + h % parts[x] for x, h in zip(leaf.tolist(), mixed.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(spot, pa.int32()), pa.array(np.zeros(n, dtype=np.int8)), pa.nulls(n, pa.binary()), batch["label"], batch["q"],
                 batch["ids"], pa.nulls(n, pa.list_(pa.float64())), pa.nulls(n, pa.list_(pa.float64()))], names,
            )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Parts one after the other: first the rows of each, then the searches."""
        part, rows, ready = None, [], None

        def answers(batch: pa.RecordBatch) -> pa.RecordBatch:
            vectors, labels, first, ids = ready
            anchors, own = matrix(batch["q"], width), batch["label"].to_numpy()
            scores = anchors @ vectors.T
            wanted = (own[:, None] == labels[None, :]) == same
            bounds = [np.array(batch[c].to_pylist(), dtype=np.float64).reshape(len(batch), -1) for c in ("least", "most")]
            out = []
            for w in range(bounds[0].shape[1]):
                of, at = np.nonzero(wanted & (scores >= bounds[0][:, w, None]) & (scores <= bounds[1][:, w, None]))
                got = scores[of, at]
                best = _best(of, got, first[at], k)
                out.append((of[best], np.full(len(best), w), got[best], at[best]))
            of, w, got, at = (np.concatenate([o[j] for o in out]) if out else np.zeros(0, dtype=np.int64) for j in range(4))
            return pa.RecordBatch.from_arrays(
                [batch["aid"].take(pa.array(of.astype(np.int64))), pa.array(w.astype(np.int32)), pa.array(got.astype(np.int64)),
                 ids.take(pa.array(at.astype(np.int64)))], ["aid", "window", "score", "ids"],
            )

        for whole in batches:
            at = whole["part"].to_numpy()
            kind = whole["kind"].to_numpy()
            edges = np.flatnonzero((np.diff(at) != 0) | (np.diff(kind) != 0)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(whole)]):
                if a == b:
                    continue
                if at[a] != part:
                    part, rows, ready = at[a], [], None
                if kind[a] == 0:
                    rows.append(whole.slice(a, b - a))
                    continue
                if not rows:
                    continue
                if ready is None:
                    held = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
                    first = np.array([x.values[0].as_py() for x in held["ids"]], dtype=np.int64)
                    ready = matrix(held["q"], width), held["label"].to_numpy(), first, held["ids"]
                for low in range(a, b, SEARCHES_TOGETHER):
                    yield answers(whole.slice(low, min(b, low + SEARCHES_TOGETHER) - low))

    dealt = entries.mapInArrow(deal, schema).unionByName(routed)
    sorted_parts = dealt.repartition("part").sortWithinPartitions("part", "kind")
    return sorted_parts.mapInArrow(scan, "aid BINARY, window INT, score BIGINT, ids ARRAY<BIGINT>")


def _top(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first ``k`` different (score, vec_id) of each key, with their rank."""
    flat = found.select(*keys, "score", F.explode("ids").alias("vec_id"))
    by = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return flat.withColumn("place", F.row_number().over(by)).where(F.col("place") <= k)


def hard_negatives(
    rows: DataFrame, anchors: str, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
    scale: int = SCALE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows(vec_id, label, embedding)``; ``anchors`` is a SQL condition on vec_id.  A
    component x counts as floor(scale * x), a score is the inner product, a whole number;
    higher ones come first, ties by smaller vec_id.  For each anchor and each of its first
    ``positives`` other rows of its label: the first ``negatives`` rows of other labels
    with low * positive <= 100 * negative <= high * positive.  Anchors or positives without
    such a row have none in the result.

    Rows with a NULL id, label or vector, or a NULL or non-finite component take no part;
    an empty vector scores 0, shorter ones count as filled with zeros, vectors too long for
    exact scores raise.  Repeated rows are one; rows that share a vec_id but not the vector
    and label are rows of their own, and never each other's positive.  Other columns are
    not looked at.
    """
    known = stored(prepared(rows, scale), "vectors")
    measured = known.agg(F.max("norm"), F.max(F.octet_length("q"))).first()
    longest, width = float(measured[0] or 0), (measured[1] or 0) // 4
    # of equal rows the smallest ids: an anchor among them leaves as many as are wanted
    wanted = max(positives + 1, negatives)
    rank = F.dense_rank().over(Window.partitionBy("label", "q").orderBy("vec_id"))
    firsts = known.select("label", "q", "vec_id").withColumn("place", rank).where(F.col("place") <= wanted)
    entries = firsts.groupBy("label", "q").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))
    entries, tree, sample, held = index(stored(entries, "entries"), longest, width)

    # one search for all anchors of equal vector and label
    chosen = known.where(anchors).select("vec_id", F.expr("unhex(md5(concat(CAST(concat(label, ':') AS BINARY), q)))").alias("aid"), "label", "q")
    chosen = stored(chosen.distinct(), "anchors")
    asked = chosen.select("aid", "label", "q").distinct()
    members = chosen.select(F.col("vec_id").alias("anchor_id"), "aid")
    any_score = {"least": F.array(F.lit(-float(EXACT))), "most": F.array(F.lit(float(EXACT)))}
    found = search(entries, tree, sample, held, asked.withColumns(any_score), width, True, positives + 1)
    best = stored(_top(found, ["aid"], positives + 1).select("aid", "score", "vec_id"), "positives")

    scores = best.groupBy("aid").agg(F.array_sort(F.collect_set("score")).alias("scores"))
    windows = asked.join(scores, "aid").withColumns(
        {"least": F.expr(f"transform(scores, s -> ceil({low} * s / 100BD))"), "most": F.expr(f"transform(scores, s -> floor({high} * s / 100BD))")}
    )
    windows = stored(windows, "windows")
    found = search(entries, tree, sample, held, windows.drop("scores"), width, False, negatives)
    named = found.join(windows.select("aid", "scores"), "aid").select(
        "aid", F.expr("scores[window]").alias("positive_score"), "score", "ids"
    )
    below = _top(named, ["aid", "positive_score"], negatives).select(
        "aid", "positive_score", F.col("place").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    by = Window.partitionBy("anchor_id", "aid").orderBy(F.desc("score"), "vec_id")
    mine = members.join(best, "aid").where("anchor_id <> vec_id").withColumn("place", F.row_number().over(by))
    mine = mine.where(F.col("place") <= positives).select(
        "anchor_id", F.col("vec_id").alias("positive_id"), "aid", F.col("score").alias("positive_score")
    )
    return mine.join(below, ["aid", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
