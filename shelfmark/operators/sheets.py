"""Many small boxes on few sheets, and back: shelves of boxes, sheets of shelves, both from prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators import ranges

PLACED = ["sheet", "x", "y"]


def sheet_layout(boxes: DataFrame, key: list[str], ident: str, w: str, h: str, width: int, height: int, parts: int = ranges.PARTS) -> DataFrame:
    """boxes with sheet (from 0, of its key), x and y: where each box's upper left corner lies. Boxes do not meet and stay within their sheet.

    The highest boxes come first, ident breaks ties. A shelf begins wherever the widths so far, laid end to end, pass another width - greatest width + 1: so what begins on
    a shelf ends on it. Shelves are laid on sheets the same way by their greatest heights. No step depends on the one before but through sums, which are
    carried along in parts. Boxes larger than a sheet, empty ones and those without a size have nulls; whole numbers; equal idents of a key must not be repeated.
    """
    bw, bh = F.col(w).cast("long"), F.col(h).cast("long")
    fits = F.coalesce(bw.between(1, width) & bh.between(1, height), F.lit(False))
    own = boxes.filter(fits).select(*key, ident, bw.alias("__w"), bh.alias("__h"), (-bh).alias("__low"))
    widest = own.groupBy(*key).agg(F.max("__w").alias("__widest"), F.max("__h").alias("__highest"))
    laid = ranges.carried(own, key, "__low", [ident], total={"__upto": F.col("__w")}, parts=parts).withColumn("__from", F.col("__upto") - F.col("__w"))
    owners = [f"__g{i}" for i in range(len(key))]
    keyed = ranges.same_key(key, owners)
    on = lambda df, *extra: df.select(*[F.col(k).alias(o) for k, o in zip(key, owners, strict=True)], *[F.col(c).alias("__j") for c in extra], *[c for c in df.columns if c not in (*key, *extra)])
    shelved = laid.join(on(widest), keyed).withColumn("__shelf", F.floor(F.col("__from") / (F.lit(width + 1) - F.col("__widest")))).drop(*owners)
    shelves = shelved.groupBy(*key, "__shelf").agg(F.min("__from").alias("__begin"), F.max("__h").alias("__deep"), F.max("__highest").alias("__highest"))
    stacked = ranges.carried(shelves, key, "__shelf", [], total={"__down": F.col("__deep")}, parts=parts).withColumn("__top", F.col("__down") - F.col("__deep"))
    sheeted = stacked.withColumn("__sheet", F.floor(F.col("__top") / (F.lit(height + 1) - F.col("__highest"))))
    # A high shelf may pass several sheets' worth: those that were begun are numbered.
    begun = sheeted.groupBy(*key, "__sheet").agg(F.min("__top").alias("__first"))
    firsts = ranges.carried(begun, key, "__sheet", [], total={"sheet": F.lit(1)}, parts=parts).withColumn("sheet", F.col("sheet") - 1)
    tops = sheeted.join(on(firsts, "__sheet"), keyed & (F.col("__sheet") == F.col("__j"))).select(*key, "__shelf", "__begin", "sheet", (F.col("__top") - F.col("__first")).alias("y"))
    placed = shelved.join(on(tops, "__shelf"), keyed & (F.col("__shelf") == F.col("__j"))).select(*key, ident, "sheet", (F.col("__from") - F.col("__begin")).alias("x"), "y")
    return boxes.join(on(placed, ident), keyed & (F.col(ident) == F.col("__j")), "left").select(*boxes.columns, *[F.col(c).cast("long").alias(c) for c in PLACED])


def found_on_sheets(places: DataFrame, layout: DataFrame, key: list[str], ident: str, w: str, h: str) -> DataFrame:
    """places (key, sheet, px, py, ...) with the box that each lies in and the place in that box, dx and dy; places between boxes are left out."""
    boxes = layout.filter("sheet IS NOT NULL").select(*key, "sheet", ident, F.col("x").alias("__x1"), (F.col("x") + F.col(w) - 1).alias("__x2"), F.col("y").alias("__y1"), (F.col("y") + F.col(h) - 1).alias("__y2"))
    met = ranges.stab(places, boxes, [*key, "sheet"], [("px", "__x1", "__x2"), ("py", "__y1", "__y2")])
    return met.select(*places.columns, ident, (F.col("px") - F.col("__x1")).alias("dx"), (F.col("py") - F.col("__y1")).alias("dy"))
