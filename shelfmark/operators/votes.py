"""Straight lines by voting: each point votes for all lines through it, and lines with the most votes of their neighbourhood stay."""

from __future__ import annotations

from functools import reduce
from math import cos, pi, sin

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Cosines and sines are whole numbers over this, so that votes are counted exactly everywhere.
UNIT = 1 << 20


def directions(angles: int) -> list[tuple[int, int]]:
    """The normals of angles lines, from 0 to under 180 degrees, in UNITs."""
    return [(round(cos(pi * k / angles) * UNIT), round(sin(pi * k / angles) * UNIT)) for k in range(angles)]


def line_votes(points: DataFrame, key: list[str], x: str, y: str, angles: int = 36, step: int = 4, least: int = 8) -> DataFrame:
    """(key, angle, offset, votes): the lines of a page on which at least so many points lie, and no neighbouring line has more.

    A line is all places with x * cos + y * sin from offset * step to under (offset + 1) * step, for the normal at angle / angles of a half
    turn. Neighbours are one angle, one offset or both away; past the last angle the first comes again, turned round. Of neighbours with equal votes the least angle
    and offset stays. Places are whole numbers; a point without one doesn't vote, points that repeat vote each time. Votes are summed in each task before they are sent.
    """
    normals = F.explode(F.array(*[F.struct(F.lit(k).alias("angle"), F.lit(c).alias("c"), F.lit(s).alias("s")) for k, (c, s) in enumerate(directions(angles))]))
    voted = points.select(*key, F.col(x).cast("long").alias("__x"), F.col(y).cast("long").alias("__y"), normals.alias("n")).filter("__x IS NOT NULL AND __y IS NOT NULL")
    offset = F.floor((F.col("__x") * F.col("n.c") + F.col("__y") * F.col("n.s")) / F.lit(float(UNIT * step))).cast("long")
    cells = voted.groupBy(*key, F.col("n.angle").alias("angle"), offset.alias("offset")).agg(F.count(F.lit(1)).alias("votes")).filter(F.col("votes") >= least)
    around = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a, b) != (0, 0)]))
    beside = cells.withColumn("s", around).withColumn("__angle", F.col("angle") + F.col("s.a"))
    over = (F.col("__angle") < 0) | (F.col("__angle") >= angles)
    # What is a neighbour of whom is said by the one with more votes: it strikes the others out.
    struck = beside.select(
        *key, F.pmod("__angle", F.lit(angles)).alias("angle"), (F.when(over, -F.col("offset") - 1).otherwise(F.col("offset")) + F.col("s.b")).alias("offset"),
        F.struct(F.col("votes"), -F.col("angle"), -F.col("offset")).alias("by"),
    ).groupBy(*key, "angle", "offset").agg(F.max("by").alias("by"))
    names = [*key, "angle", "offset"]
    renamed = struck.select(*[F.col(c).alias(f"__{i}") for i, c in enumerate(names)], "by")
    mine = F.struct(F.col("votes"), -F.col("angle"), -F.col("offset"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{i}")) for i, c in enumerate(names)])
    return cells.join(renamed, same, "left").filter(F.col("by").isNull() | (mine > F.col("by"))).select(*names, "votes")
