"""Connected components, and linking nodes that share keys, without forming all pairs of a key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch


def components(links: DataFrame, scratch: Scratch, label: str = "labels") -> DataFrame:
    """(node, root) for every node in ``links`` (a, b): root is the least node reachable.

    Alternates two steps on the stored links: every node's larger neighbours are hung on the
    least of its neighbours and itself, then a node and its smaller neighbours on the least of
    these. It ends when only stars are left: every node hangs on one root, and no root on another
    node. The number of rounds grows with the logarithm of the longest chain; nothing but the
    answer to that question comes to the driver.
    """
    edges = links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo")
    stored = None
    while True:
        both = edges.select(F.col("hi").alias("n"), F.col("lo").alias("m")).union(
            edges.select(F.col("lo").alias("n"), F.col("hi").alias("m"))
        )
        least = both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("least"))
        large = edges.join(least, edges["lo"] == least["n"]).select("hi", F.col("least").alias("lo")).where("hi <> lo")
        lower = large.groupBy("hi").agg(F.min("lo").alias("least"))
        moved = large.join(lower, "hi").select(F.col("lo").alias("hi"), F.col("least").alias("lo")).where("hi <> lo")
        after = scratch.put(lower.select("hi", F.col("least").alias("lo")).union(moved).distinct(), f"{label}-round")
        if stored is not None:
            scratch.drop(stored)
        edges = stored = after
        ends = edges.select(F.col("hi").alias("n"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).union(
            edges.select(F.col("lo"), F.lit(0), F.lit(1))
        )
        per_node = ends.groupBy("n").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
        if per_node.where("hangs > 1 or hangs = 1 and holds = 1").isEmpty():
            break
    roots = edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return roots.union(edges.select(F.col("lo"), F.col("lo")).distinct())


#: How many members of each key are compared with the rest of it in the first round, by how much
#: that grows, and how many members a key may have left before it is divided into finer keys.
FIRST_WIDTH, WIDER, SHORT = 1, 16, 8


def _of_sets(members: DataFrame) -> list[Column]:
    """n and rest, null where keys say nothing about the place of a value in the set."""
    return [(F.col(c) if c in members.columns else F.lit(None)).cast("long").alias(c) for c in ("n", "rest")]


def link_by_keys(
    members: DataFrame,
    confirm: Callable[[DataFrame], DataFrame],
    scratch: Scratch,
    label: str = "link",
    finer: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(node, root) of the components that all confirmed pairs with a common key would make.

    ``members``: distinct (key, node), or (key, node, n, rest), a stored table. ``confirm`` takes distinct pairs (a, b)
    and returns those that hold. In each round, the first members of every key (one, then
    sixteen times as many as before) are compared with the members that are not yet in their
    component, and then leave the key. A key is done when what is left of it is one component or
    one node. So a thousand copies that are alike cost about a thousand comparisons rather than half
    a million; only members that are truly unlike are compared with each other.

    Where more than ``SHORT`` unlike members of a key are left after the first round, ``finer``
    gives these nodes more selective keys, on which the rounds go on instead, in the same columns.

    ``n`` and ``rest`` are the size of the node's set and the number of its values from this one on,
    in an order that all sets share (null: not known). Then pairs at a similarity of 0.75 have an overlap of
    3 / 7 of both sizes, and are formed only where both leave as much. First among the members are those that
    leave most: what is near to many others is near to the middle of the group.
    """
    every: DataFrame | None = None
    width = FIRST_WIDTH
    live = members.select("key", "node", F.col("node").alias("root"), *_of_sets(members))
    while True:
        order = Window.partitionBy("key").orderBy((F.col("rest") / F.col("n")).desc(), "node")
        placed = live.withColumn("place", F.row_number().over(order))
        x, y = placed.where(F.col("place") <= width).alias("x"), placed.alias("y")
        ahead = (F.col("x.place") < F.col("y.place")) & (F.col("x.root") != F.col("y.root"))
        overlap = 7 * F.least("x.rest", "y.rest") >= 3 * (F.col("x.n") + F.col("y.n"))
        pairs = (
            x.join(y, (F.col("x.key") == F.col("y.key")) & ahead & F.coalesce(overlap, F.lit(True)))
            .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
            .distinct()
        )
        found = scratch.put(confirm(pairs), f"{label}-found")
        every = found if every is None else every.union(found)
        roots = scratch.put(components(every, scratch, label), f"{label}-roots")
        # Compared members leave; so do keys whose other members are all in one component.
        left = placed.where(F.col("place") > width).select("key", "node", "n", "rest")
        if left.isEmpty():
            return roots
        spread = left.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"), "n", "rest")
        kinds = spread.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1"))
        unlike = kinds.where("r0 <> r1").select("key")
        live = scratch.put(spread.join(unlike, "key", "left_semi"), f"{label}-live")
        if finer is not None and width == FIRST_WIDTH:
            live = scratch.put(_divided(live, finer), f"{label}-finer")
        if live.isEmpty():
            return roots
        width *= WIDER


def _divided(live: DataFrame, finer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``live`` (key, node, root, n, rest) with the members of long keys under finer keys."""
    long_keys = live.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > SHORT).select("key")
    nodes = live.join(long_keys, "key", "left_semi").select("node", "root").distinct()
    found = finer(nodes.select("node"))
    keyed = found.select("key", "node", *_of_sets(found)).join(nodes, "node").select("key", "node", "root", "n", "rest")
    kinds = keyed.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1"))
    unlike = kinds.where("r0 <> r1").select("key")
    return live.join(long_keys, "key", "left_anti").union(keyed.join(unlike, "key", "left_semi"))
