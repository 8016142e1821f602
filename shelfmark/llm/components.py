"""Connected components by rounds of hooking and pointer jumping, all in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import Stored


def components(edges: DataFrame) -> Stored:
    """(node, root) for every node of edges (a, b): root is the least node of its component.

    In each round every node hooks onto its least neighbour, and edges are drawn again between the
    roots. At least half of the nodes with edges vanish in a round, so rounds grow with the
    logarithm of the longest component. Nothing is collected.
    """
    left = Stored(edges.filter("a <> b").distinct(), "edges")
    known = Stored(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("root")), "roots")
    while not left.df().isEmpty():
        both = left.df().unionByName(left.df().select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = Stored(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("up")), "hooks")
        # A node's parent may have hooked onward itself: follow it until no one moves.
        while True:
            up = hook.df().select(F.col("node").alias("up"), F.col("up").alias("top"))
            jumped = Stored(hook.df().join(up, "up", "left").select("node", F.coalesce("top", "up").alias("up"), (F.coalesce("top", "up") != F.col("up")).alias("moved")), "hooks")
            moved = not jumped.df().filter("moved").isEmpty()
            hook.drop()
            hook = jumped
            if not moved:
                break
        to = hook.df().select(F.col("node").alias("root"), F.col("up").alias("new"))
        next_known = Stored(known.df().join(to, "root", "left").select("node", F.coalesce("new", "root").alias("root")), "roots")
        a, b = (hook.df().select(F.col("node").alias(k), F.col("up").alias(f"new_{k}")) for k in ("a", "b"))
        drawn = left.df().join(a, "a", "left").join(b, "b", "left").select(F.coalesce("new_a", "a").alias("a"), F.coalesce("new_b", "b").alias("b"))
        next_left = Stored(drawn.filter("a <> b").distinct(), "edges")
        for old in (left, known, hook):
            old.drop()
        left, known = next_left, next_known
    left.drop()
    return known
