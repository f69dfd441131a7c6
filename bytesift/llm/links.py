"""Connected components of links between documents that share keys.

A key (a prefix shingle, a band of a signature) may be shared by thousands of
near copies.  Comparing all of them with each other is what must not happen, and
need not: for components it is enough to know which classes touch.  So a round
compares each member of a key with one hub, merges what is linked, and goes on
with the keys whose members are still in several components.  When few enough
pairs are left, all of them are compared.  No pair of different components that
shares a key is ever left out, so the components are exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bytesift.llm.store import stored

# Rounds with hubs go on while more pairs than this per posting are left and the
# last round linked at least one in FEW of its pairs, ...
PAIRS_PER_POSTING = 4
FEW = 50
# ... each with this many times more hubs per key than the one before.
MORE_HUBS = 8


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node that edges (a, b) connect a node with.

    Each node points to its smallest neighbour if that is smaller; pointers are
    followed to their ends by doubling; edges between ends are what is left for
    the next turn.  Every turn removes at least half of the ends that have edges.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    left = stored(both.where("a <> b").distinct(), "edges")
    comp = None
    while left.take(1):
        up = stored(left.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("comp")), "up")
        while True:
            ahead = up.select(F.col("node").alias("comp"), F.col("comp").alias("next"))
            jumped = stored(
                up.join(ahead, "comp", "left").select("node", F.coalesce("next", "comp").alias("comp"), (F.coalesce("next", "comp") != F.col("comp")).alias("moved")),
                "jumped",
            )
            up = jumped.select("node", "comp")
            if not jumped.where("moved").take(1):
                break
        if comp is None:
            comp = up
        else:
            ends = up.select(F.col("node").alias("comp"), F.col("comp").alias("next"))
            comp = stored(comp.join(ends, "comp", "left").select("node", F.coalesce("next", "comp").alias("comp")), "comp")
        a = up.select(F.col("node").alias("a"), F.col("comp").alias("ca"))
        b = up.select(F.col("node").alias("b"), F.col("comp").alias("cb"))
        left = stored(
            left.join(a, "a").join(b, "b").where("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct(),
            "edges",
        )
    return edges.select(F.col("a").alias("node"), F.col("b").alias("comp")).limit(0) if comp is None else comp


def _with_components(postings: DataFrame, comp: DataFrame | None) -> DataFrame:
    if comp is None:
        return postings.withColumn("comp", F.col("node"))
    return postings.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def linked_components(
    postings: DataFrame, may_link: str, verify: Callable[[DataFrame], DataFrame]
) -> DataFrame | None:
    """(node, comp) of the nodes that have a link; None if no node has one.

    ``postings(key, node, ...)`` is a stored table, each (key, node) once.
    ``may_link`` is a SQL condition on a pair of postings of one key, its columns
    prefixed with a_ and b_: for two linked nodes it holds at one key at least.
    ``verify`` takes distinct pairs (a, b), a < b, and returns the linked ones.
    """
    more = [c for c in postings.columns if c not in ("key", "node")]
    as_a = [F.col("node").alias("a"), *[F.col(c).alias(f"a_{c}") for c in [*more, "comp"]]]
    as_b = [F.col("node").alias("b"), *[F.col(c).alias(f"b_{c}") for c in [*more, "comp"]]]
    total = postings.count()
    comp, links, tested, hubs, fruitful = None, None, None, 1, True
    while total:
        live = _with_components(postings, comp)
        sizes = live.groupBy("key", "comp").agg(F.count("*").alias("n"))
        squared = F.sum(F.col("n").cast("double") * F.col("n"))
        open_keys = (
            sizes.groupBy("key")
            .agg(F.sum("n").alias("n"), squared.alias("squares"), F.max(F.struct("n", "comp"))["comp"].alias("largest"))
            .withColumn("pairs", (F.col("n").cast("double") * F.col("n") - F.col("squares")) / 2)
            .where("pairs > 0")
        )
        open_keys = stored(open_keys.select("key", "pairs", "largest"), "open")
        pairs_left = open_keys.agg(F.sum("pairs")).first()[0]
        if not pairs_left:
            break
        live = stored(live.join(open_keys.select("key", "largest"), "key"), "live")
        last = hubs > 1 and (pairs_left <= PAIRS_PER_POSTING * total or not fruitful)
        if last:
            # who is outside the largest component of a key meets all the others:
            # at most four times as many rows as there are pairs left
            left = live.where("comp <> largest")
        else:
            struct = F.struct(*["comp", "node", *more])
            spot = F.pmod(F.xxhash64("node", F.lit(hubs)), F.lit(hubs))
            left = live.groupBy("key", spot.alias("spot")).agg(F.min(struct).alias("hub")).select("key", "hub.*")
        both = left.select("key", *as_a).join(live.select("key", "largest", *as_b), "key")
        both = both.where("a_comp <> b_comp").where(may_link)
        pairs = both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        found = stored(verify(pairs), "links")
        links = found if links is None else links.unionByName(found)
        n_found = found.count()
        if n_found:
            comp = components(links)
        if last:
            break
        fruitful = n_found * FEW >= pairs.count()
        tested = pairs if tested is None else tested.unionByName(pairs)
        hubs *= MORE_HUBS
    return comp
