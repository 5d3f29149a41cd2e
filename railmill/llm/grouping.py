"""Groups of near-equal things from hash buckets: verified links, then connected components.

Nothing here builds all pairs of a bucket. Every bucket first compares its members with one
centre, so a bucket of n copies costs n comparisons. Only members that still lie in different
groups are then compared with each other; afterwards every pair that shares a bucket is either
in one group or has been compared. The result is therefore the same as comparing all pairs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railmill.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, label)``: the smallest node that links reach, for every node with a link.

    Union-find by alternating star contractions: larger neighbours hang themselves below the
    smallest neighbour, then smaller ones do, until nothing changes. Minima combine before their
    shuffle, and the rows of a hot node are only ever joined, so Spark can split them. The
    rounds grow with the logarithm of the longest path.
    """

    def star(edges: DataFrame, larger: bool) -> DataFrame:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        if larger:
            least = scratch.keep(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")
            rows = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            down = both.filter("v < u")
            least = scratch.keep(down.groupBy("u").agg(F.min("v").alias("m")), "least")
            rows = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            rows = rows.unionByName(least.select("u", F.col("m").alias("v")))
        return rows.filter("u <> v").distinct()

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    edges = scratch.keep(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges"
    )
    before = state(edges)
    while before[0]:
        edges = scratch.keep(star(scratch.keep(star(edges, larger=True), "large"), larger=False), "small")
        after = state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)


def group(
    buckets: DataFrame,
    sketches: DataFrame,
    maybe: Callable[[str, str], Column],
    verify: Callable[[DataFrame, bool], DataFrame],
    scratch: Scratch,
    known: DataFrame | None = None,
) -> DataFrame:
    """``(node, label)`` for every node that is linked with another one.

    ``buckets(key, node)``: nodes that share a key may be linked; keys without any such pair may be left
    out. ``sketches(node, sketch)``:
    one struct per node. ``maybe(a, b)`` says from two sketch columns whether a pair may be
    linked. ``verify`` takes pairs ``(a, b, sketch_a, sketch_b)``, where many pairs may share one
    ``b``, and returns the linked ones as ``(a, b)``; its flag tells the comparison with the centres,
    which is the bulk, from that of the rest. ``known`` holds links that need no proof.
    """

    def with_sketches(pairs: DataFrame) -> DataFrame:
        left = sketches.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a"))
        right = sketches.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b"))
        return pairs.join(left, "a").join(right, "b").filter(maybe("sketch_a", "sketch_b"))

    shared = buckets.groupBy("key").agg(F.min("node").alias("b"), F.max("node").alias("last")).filter("b < last")
    shared = scratch.keep(shared.select("key", "b"), "shared")
    members = scratch.keep(buckets.join(shared, "key").select("key", "b", "node"), "members")
    pairs = members.filter("node <> b").select(F.col("node").alias("a"), "b").distinct()
    links = verify(scratch.keep(with_sketches(pairs), "pairs"), True)
    links = scratch.keep(links if known is None else links.unionByName(known), "links")
    labels = scratch.keep(components(links, scratch), "labels")

    labelled = members.join(labels, "node", "left").select(
        "key", "b", "node", F.coalesce("label", "node").alias("label")
    )
    labelled = scratch.keep(labelled.distinct(), "labelled")
    sizes = labelled.groupBy("key", "label").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("n", "label"))["label"].alias("largest"), F.count("*").alias("k"))
    largest = scratch.keep(largest, "largest")
    open_rows = labelled.join(largest.filter("k > 1").select("key", "largest"), "key")
    open_rows = scratch.keep(open_rows.filter("node <> b").join(sketches, "node"), "open")
    some, other = open_rows.filter("label <> largest").alias("s"), open_rows.alias("o")
    across = some.join(
        other,
        (F.col("s.key") == F.col("o.key"))
        & (F.col("s.label") != F.col("o.label"))
        & ((F.col("o.label") == F.col("o.largest")) | (F.col("s.node") < F.col("o.node")))
        & maybe("s.sketch", "o.sketch"),
    )
    rest = across.select(
        F.col("s.node").alias("a"),
        F.col("o.node").alias("b"),
        F.col("s.sketch").alias("sketch_a"),
        F.col("o.sketch").alias("sketch_b"),
    ).dropDuplicates(["a", "b"])
    more = scratch.keep(verify(scratch.keep(rest, "rest"), False), "more")
    if more.isEmpty():
        return labels
    return components(more.unionByName(labels.select(F.col("node").alias("a"), F.col("label").alias("b"))), scratch)
