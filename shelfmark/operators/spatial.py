"""Joins by place: points in rectangles, nearest separators, neighbours. Always on an image (or other) key first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.operators import names, ranges

#: Templates that are broadcast, at most.
TEMPLATES = 10_000


def first_match(joined: DataFrame, keys: list[str], order: list[str], keep: list[str]) -> DataFrame:
    """Of each key's matches the least in order, as one aggregate: nothing is sorted and a hot key is combined before the shuffle."""
    best = F.min_by(F.struct(*keep), F.struct(*order)).alias("__best")
    return joined.groupBy(*keys).agg(best).select(*keys, *[F.col(f"__best.{c}").alias(c) for c in keep])


def point_in_region(points: DataFrame, regions: DataFrame, key: str, ids: list[str], order: list[str], keep: list[str]) -> DataFrame:
    """Each point (key, x, y) with the first region (key, x1, y1, x2, y2) that holds it; x1 <= x < x2. Points in none keep nulls.

    order: the regions' columns that decide, such as whether the date was read there, then the ordinal.
    """
    inside = (F.col("x") >= F.col("x1")) & (F.col("x") < F.col("x2")) & (F.col("y") >= F.col("y1")) & (F.col("y") < F.col("y2"))
    hits = ranges.stab(points, regions, [key], [("x", "x1", "x2"), ("y", "y1", "y2")]).filter(inside)
    found = first_match(hits, [key, *ids], order, keep)
    return points.join(found, [key, *ids], "left")


def tokens_in_cells(tokens: DataFrame, cells: DataFrame, key: str | list[str], cell: str, order: list[str], limit: int | None = 14, slack: int = 2) -> DataFrame:
    """The first tokens of each cell (closed on all sides, with some slack), joined by blanks; all of them without a limit.

    key: what a token and a cell must share, an image or an image and a variant of it.
    """
    key = [key] if isinstance(key, str) else key
    wider = cells.withColumns({"__x1": F.col("x1") - slack, "__x2": F.col("x2") + slack, "__y1": F.col("y1") - slack, "__y2": F.col("y2") + slack})
    hits = ranges.stab(tokens, wider, key, [("x", "__x1", "__x2"), ("y", "__y1", "__y2")])
    # The limit is taken below the shuffle too, so a crowded cell sends limit rows a task.
    first = hits.withColumn("__rn", F.row_number().over(Window.partitionBy(*key, cell).orderBy(*order, "text")))
    if limit is not None:
        first = first.filter(F.col("__rn") <= limit)
    parts = F.array_sort(F.collect_list(F.struct("__rn", "text")))
    return first.groupBy(*key, cell).agg(F.array_join(F.transform(parts, lambda t: t["text"]), " ").alias("text"), F.count(F.lit(1)).alias("n"))


def overlapping(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Pairs of intervals [a_lo, a_hi] and [b_lo, b_hi] of one key that meet; one that ends before it begins meets none."""
    return ranges.meeting(a, b, [key], ("a_lo", "a_hi"), ("b_lo", "b_hi"))


def nearest_separator(gaps: DataFrame, lines: DataFrame, key: str, gap: str, strong: float = 0.55) -> DataFrame:
    """Between two neighbours (key, gap, lo, hi, target) the strong line (key, pos, length) nearest to the target, else the target itself.

    A line is strong if it has at least that share of the longest one in the gap; ties go to the lesser position.
    """
    inside = ranges.stab(lines, gaps, [key], [("pos", "lo", "hi")]).filter((F.col("pos") > F.col("lo")) & (F.col("pos") < F.col("hi")))
    longest = inside.groupBy(key, gap).agg(F.max("length").alias("longest"))
    near = inside.join(longest, [key, gap]).filter(F.col("length") >= F.col("longest") * strong).withColumn("__far", F.abs(F.col("pos") - F.col("target")))
    best = first_match(near, [key, gap], ["__far", "pos"], ["pos"])
    return gaps.join(best, [key, gap], "left").withColumn("separator", F.coalesce("pos", "target")).drop("pos")


def row_windows(points: DataFrame, key: str, ident: str, y: str, height: Column, span: int = 1) -> DataFrame:
    """(key, ident, y1, y2): the rows of text that points (bullets) begin, span of them at a time, on a page of so much height.

    A row ends a tenth of the gap, three pixels at least, before the next point; the last one takes 1.7 median gaps of the page, 65 pixels
    at least. A row is 18 pixels high at least, the page permitting. Positions are whole pixels.
    """
    w, page = Window.partitionBy(key).orderBy(y, ident), Window.partitionBy(key)
    gaps = points.withColumns({"__i": F.row_number().over(w), "__gap": F.lead(y).over(w) - F.col(y)})
    gaps = gaps.withColumns({"__middle": F.coalesce(F.median("__gap").over(page), F.lit(40.0)), "__n": F.count(F.lit(1)).over(page)})
    # The last point of the span, or the page's last; what follows it.
    last = F.coalesce(F.lead(F.struct(y, "__gap"), span - 1).over(w), F.last(F.struct(y, "__gap")).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    shown = gaps.withColumns({"y1": F.greatest(F.lit(0), F.col(y) - 8), "__last": last})
    at, gap = F.col(f"__last.{y}"), F.greatest(F.lit(1), F.col("__last.__gap"))
    before = F.greatest(F.col("y1") + 18, at + F.col("__last.__gap") - F.greatest(F.lit(3), F.bround(gap * 0.10)))
    end = F.least(height, F.floor(at + F.greatest(F.lit(65.0), 1.7 * F.col("__middle"))))
    y2 = F.when(F.col("__last.__gap").isNotNull(), before).otherwise(end)
    y2 = F.when(y2 - F.col("y1") < 18, F.least(height, F.col("y1") + 24)).otherwise(y2)
    return shown.select(key, ident, F.col("y1").cast("long").alias("y1"), F.least(height, y2).cast("long").alias("y2"))


def left_neighbour(glyphs: DataFrame, key: str, glyph: str, reach: float, lo: float = 0.78, hi: float = 1.25) -> DataFrame:
    """Each glyph with the nearest one to its left (key, left, right, height) within reach and of like height."""
    other = glyphs.select(F.col(key), F.col(glyph).alias("neighbour"), F.col("right").alias("__r"), F.col("height").alias("__h"))
    # Sought a little further: the exact gap decides.
    reaching = glyphs.withColumns({"__from": F.col("left") - reach - 1, "__to": F.col("left") + 1})
    gap = F.col("left") - F.col("__r")
    met = ranges.stab(other, reaching, [key], [("__r", "__from", "__to")])
    near = met.filter((F.col(glyph) != F.col("neighbour")) & gap.between(0, reach) & F.col("__h").between(F.col("height") * lo, F.col("height") * hi)).withColumn("__gap", gap)
    return first_match(near, [key, glyph], ["__gap", "neighbour"], ["neighbour"])


def nearest_template(vectors: DataFrame, templates: DataFrame, value: Column, template: Column, keys: list[str], label: str) -> DataFrame:
    """Each vector with the label of the template at the least mean squared distance, and that distance.

    Up to TEMPLATES templates are broadcast; more meet the vectors in tiles. keys tell vectors apart, labels templates.
    """
    dist = F.aggregate(F.zip_with(value, template, lambda a, b: (a.cast("double") - b.cast("double")) * (a.cast("double") - b.cast("double"))), F.lit(0.0), lambda s, x: s + x) / F.size(value)
    few = templates.limit(TEMPLATES + 1).count() <= TEMPLATES
    pairs = (vectors.crossJoin(F.broadcast(templates)) if few else names.all_pairs(vectors, keys, templates, [label])).withColumn("distance", dist)
    return first_match(pairs, keys, ["distance", label], [label, "distance"])


def anchor_cells(anchors: DataFrame, key: list[str], ident: str, width: float) -> DataFrame:
    """anchors (line, x, bottom) with the area that each one's name can be in: x1, x2, y1, and its column."""
    lines = anchors.groupBy(*key, "line").agg(F.max("bottom").alias("__b"))
    above = lines.withColumn("y1", F.coalesce(F.lag("__b").over(Window.partitionBy(*key).orderBy("line")), F.lit(0.0))).drop("__b")
    w = Window.partitionBy(*key, "line").orderBy("x", ident)
    placed = anchors.join(above, [*key, "line"])
    return placed.withColumns({"x1": F.coalesce((F.lag("x").over(w) + F.col("x")) / 2, F.lit(0.0)), "x2": F.coalesce((F.col("x") + F.lead("x").over(w)) / 2, F.lit(width)), "col": F.row_number().over(w).cast("long")})


def is_banner(width: int, height: int, least_fill: float = 0.45) -> Column:
    """Components (w, h, fill) that are filled banners of a page of this size."""
    w, h = F.col("w"), F.col("h")
    return (w >= max(120, int(width * 0.10))) & (h >= max(28, int(height * 0.025))) & (h <= int(height * 0.18)) & (w * h >= height * width * 0.003) & (F.col("fill") >= least_fill)


def is_glyph(width: int, height: int) -> Column:
    """Components (w, h, fill) that can be digits of a price on a page of this size."""
    w, h = F.col("w"), F.col("h")
    return (w * h * F.col("fill") >= max(12, int(height * width * 0.000015))) & w.between(2, max(80, int(width * 0.09))) & h.between(max(15, int(height * 0.018)), max(70, int(height * 0.10)))
