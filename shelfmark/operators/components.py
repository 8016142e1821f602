"""Connected components: of links between any nodes, and of occupied cells of grids.

A grid is taken tile by tile: the cells of a tile are turned into runs of its rows, and runs that touch are joined on the
spot. What crosses the seams between tiles is a graph of tile components, far smaller than the grid, whose components are
found by hooking and jumping. No task holds more than some tiles, whatever a grid's size.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from shelfmark.operators.stored import Table

#: Cells along the side of a tile.
TILE = 64


def linked(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b): the least node that it is linked to, over any number of steps. Nodes may be of any type that has an order.

    Round by round each node hooks onto its least neighbour's side, trees are flattened by jumping from parent to parent's parent, and
    links are drawn again between roots, so at least half of the nodes that have links left go in a round. Links to itself make a node; those
    with a null end count for nothing.
    """
    whole = links.filter("a IS NOT NULL AND b IS NOT NULL")
    left = Table(whole.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "links")
    roots = whole.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node"))
    while not left.read().isEmpty():
        # Upwards only: a node's parent is less than it, so there are no rings.
        parents = Table(left.read().groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("up")), "parents")
        while True:
            above = parents.read().select(F.col("node").alias("up"), F.col("up").alias("further"))
            beyond = above.select(F.col("up").alias("further"), F.col("further").alias("furthest"))
            leaps = parents.read().join(above, "up", "left").join(beyond, "further", "left")
            jumped = Table(leaps.select("node", F.coalesce("furthest", "further", "up").alias("up"), F.col("furthest").isNotNull().alias("moved")), "parents")
            more = not jumped.read().filter("moved").isEmpty()
            parents.drop()
            parents = jumped
            if not more:
                break
        # Each round's parents are kept for the roots, which are read off at the end.
        up = parents.read().select(F.col("node").alias("root"), "up")
        roots = roots.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
        ends = left.read()
        for end in ("hi", "lo"):
            ends = ends.join(parents.read().select(F.col("node").alias(end), F.col("up").alias(f"{end}_up")), end, "left")
        drawn = ends.select(F.coalesce("hi_up", "hi").alias("x"), F.coalesce("lo_up", "lo").alias("y")).filter("x <> y")
        redrawn = Table(drawn.select(F.greatest("x", "y").alias("hi"), F.least("x", "y").alias("lo")).distinct(), "links")
        left.drop()
        left = redrawn
    left.drop()
    return roots


def runs_joined(xs: list[int], ys: list[int], diagonal: bool) -> list[int]:
    """For each cell the index of the first cell, by row and then column, of what it touches in the tile. Cells come in that order, each once."""
    runs: list[list[int]] = []  # row, first and last column, and the place of the first cell
    of_cell = []
    for k, (x, y) in enumerate(zip(xs, ys, strict=True)):
        if runs and runs[-1][0] == y and runs[-1][2] == x - 1:
            runs[-1][2] = x
        else:
            runs.append([y, x, x, k])
        of_cell.append(len(runs) - 1)
    up = list(range(len(runs)))

    def top(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    reach, above = int(diagonal), 0
    for i, (y, first, last, _) in enumerate(runs):
        while runs[above][0] < y - 1 or (runs[above][0] == y - 1 and runs[above][2] < first - reach):
            above += 1
        j = above
        while runs[j][0] == y - 1 and runs[j][1] <= last + reach:
            a, b = sorted((top(i), top(j)))
            up[b] = a
            j += 1
    return [runs[top(r)][3] for r in of_cell]


def grid_components(cells: DataFrame, key: list[str], x: str, y: str, diagonal: bool = True, tile: int = TILE) -> DataFrame:
    """(key, x, y, least_x, least_y): each occupied cell once, with the first cell of its component by row (y) and then column (x).

    Cells of one key that touch by their sides, or by their corners too where diagonal, are of one component. Repeated cells count once; cells without
    a place are left out; a null key is a grid of its own. An empty table has no components. Places are whole numbers.
    """
    own = [F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(key)]
    owners = [f"__k{i}" for i in range(len(key))]
    placed = cells.select(*own, F.col(f"`{x}`").cast("long").alias("x"), F.col(f"`{y}`").cast("long").alias("y")).filter("x IS NOT NULL AND y IS NOT NULL")
    tiles = placed.withColumns({"tx": F.floor(F.col("x") / tile).cast("long"), "ty": F.floor(F.col("y") / tile).cast("long")})
    schema = StructType([*tiles.schema.fields, StructField("fx", tiles.schema["x"].dataType), StructField("fy", tiles.schema["y"].dataType)])

    def joined(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Tiles lie one after another in a sorted partition; the last of a batch may go on in the next."""
        held = None
        for frame in frames:
            held = frame if held is None else pd.concat([held, frame], ignore_index=True)
            last = held.iloc[-1][[*owners, "tx", "ty"]]
            rest = pd.Series(True, index=held.index)
            for c in (*owners, "tx", "ty"):
                rest &= held[c].isna() if pd.isna(last[c]) else held[c] == last[c]
            if not rest.all():
                yield from of_tiles(held[~rest])
                held = held[rest]
        if held is not None and len(held):
            yield from of_tiles(held)

    def of_tiles(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for _, one in frame.groupby([*owners, "tx", "ty"], dropna=False, sort=False):
            one = one.drop_duplicates(["y", "x"])
            xs, ys = one["x"].tolist(), one["y"].tolist()
            first = runs_joined(xs, ys, diagonal)
            yield one.assign(fx=[xs[k] for k in first], fy=[ys[k] for k in first])

    # A tile has tile * tile different cells at most: repeats are folded before they are dealt.
    once = tiles.distinct().repartition(*owners, "tx", "ty").sortWithinPartitions(*owners, "tx", "ty", "y", "x")
    labelled = Table(once.mapInPandas(joined, schema), "tiles")
    node = lambda fx, fy: F.struct(*owners, F.col(fy).alias("y"), F.col(fx).alias("x"))
    # Seams: each cell at a lower border looks at its neighbours in the tiles beyond.
    steps = [(1, 0), (0, 1)] + ([(1, 1), (-1, 1)] if diagonal else [])
    around = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in steps]))
    look = labelled.read().withColumn("s", around).withColumns({"nx": F.col("x") + F.col("s.a"), "ny": F.col("y") + F.col("s.b")})
    look = look.filter((F.floor(F.col("nx") / tile) != F.col("tx")) | (F.floor(F.col("ny") / tile) != F.col("ty"))).select(*owners, "nx", "ny", node("fx", "fy").alias("a"))
    there = labelled.read().select(*[F.col(o).alias(f"{o}_") for o in owners], F.col("x").alias("nx_"), F.col("y").alias("ny_"), node("fx", "fy").alias("b"))
    same = (F.col("nx") == F.col("nx_")) & (F.col("ny") == F.col("ny_"))
    for o in owners:
        same = same & F.col(o).eqNullSafe(F.col(f"{o}_"))
    roots = linked(look.join(there, same).select("a", "b").distinct())
    found = labelled.read().withColumn("node", node("fx", "fy")).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return found.select(*[F.col(o).alias(k) for o, k in zip(owners, key, strict=True)], "x", "y", F.col("root.x").alias("least_x"), F.col("root.y").alias("least_y"))


def component_boxes(found: DataFrame, key: list[str]) -> DataFrame:
    """(key, least_x, least_y, cells, x1, y1, x2, y2, fill): a row for each component of grid_components(), with its bounding box and the share of it that is occupied."""
    boxes = found.groupBy(*key, "least_x", "least_y").agg(F.count(F.lit(1)).alias("cells"), F.min("x").alias("x1"), F.min("y").alias("y1"), F.max("x").alias("x2"), F.max("y").alias("y2"))
    return boxes.withColumn("fill", F.col("cells") / ((F.col("x2") - F.col("x1") + 1) * (F.col("y2") - F.col("y1") + 1)))
