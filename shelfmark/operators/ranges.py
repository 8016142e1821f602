"""Along an axis, without a task that sees all rows of a key: what comes before, as-of joins, points in intervals, intervals that meet.

Carries: the axis is cut at its quantiles. Each part of a key gives one summary, a scan over the summaries says what comes before
each part, and windows stay within parts. A key has PARTS summaries at most, however many rows it has.

Stabs: an interval is entered in cells about as wide as itself, two for each axis, and a point is looked up in its own cell of
each width that there is. So a pair meets once, and no more pairs meet than a few times those that are found.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Parts that an axis is cut into.
PARTS = 64
#: Widths of cells, as powers of two: shorter intervals are entered as if they had the least, longer ones as if they had the greatest.
LEAST, GREATEST = -20, 62


def number(df: DataFrame, column: str) -> Column:
    """A place on an axis as a double that keeps order: days of a date, seconds of a timestamp."""
    kind, c = df.schema[column].dataType.typeName(), F.col(f"`{column}`")
    if kind == "date":
        return F.unix_date(c).cast("double")
    if kind.startswith("timestamp"):
        return F.unix_micros(c.cast("timestamp")) / 1_000_000
    return c.cast("double")


def cut(df: DataFrame, by: str, parts: int = PARTS, name: str = "__part") -> DataFrame:
    """df with the number of the part of the axis by that a row is in; rows without a place are in part 0, before all others.

    The quantiles are approximate and any would do: they are read once and stand in the plan, parts - 1 numbers.
    """
    place = number(df, by)
    bounds = df.select(place.alias("p")).agg(F.percentile_approx("p", [k / parts for k in range(1, parts)], 1000)).first()[0] or []
    found = sorted({b for b in bounds if b == b})

    def tree(lo: int, hi: int) -> Column:
        """The number of bounds up to the place, by halving."""
        if lo == hi:
            return F.lit(lo)
        middle = (lo + hi) // 2
        return F.when(place < found[middle], tree(lo, middle)).otherwise(tree(middle + 1, hi))

    return df.withColumn(name, F.when(place.isNull(), 0).otherwise(tree(0, len(found)) + 1))


def same_key(key: list[str], renamed: list[str]) -> Column:
    """Equality of keys, null with null; no key is one key."""
    return reduce(lambda a, b: a & b, [F.lit(True), *[F.col(f"`{k}`").eqNullSafe(F.col(r)) for k, r in zip(key, renamed, strict=True)]])


def carried(
    df: DataFrame,
    key: list[str],
    by: str,
    ties: list[str],
    last: dict[str, Column] | None = None,
    previous: dict[str, Column] | None = None,
    following: dict[str, Column] | None = None,
    total: dict[str, Column] | None = None,
    most: dict[str, Column] | None = None,
    parts: int = PARTS,
) -> DataFrame:
    """df with columns that look along an axis (by, then ties, which tell rows apart) within a key.

    last: the last value that isn't null, up to this row. previous, following: the value of the row before and after, null or not. total, most: the sum and the
    greatest value up to this row, nulls left out. Null keys are one key. Rows of which neither axis nor ties differ come in any order.
    """
    looks = [(kind, name, c) for kind, group in (("last", last), ("previous", previous), ("following", following), ("total", total), ("most", most)) for name, c in (group or {}).items()]
    work = placed(df, key, by, parts).withColumns({f"__v{i}": c for i, (_, _, c) in enumerate(looks)})
    order = F.struct(*[F.col(f"`{c}`") for c in (by, *ties)])
    summaries = []
    for i, (kind, _, _) in enumerate(looks):
        v = F.col(f"__v{i}")
        if kind == "last":
            # The greatest place among the rows with a value; without any, null.
            summaries.append(F.max_by(F.struct(v.alias("v")), F.when(v.isNotNull(), order)))
        elif kind in ("previous", "following"):
            summaries.append((F.max_by if kind == "previous" else F.min_by)(F.struct(v.alias("v")), order))
        else:
            summaries.append(F.struct((F.sum(v) if kind == "total" else F.max(v)).alias("v")))
    parts_of = work.groupBy("__key", "__part").agg(*[s.alias(f"__s{i}") for i, s in enumerate(summaries)])
    earlier = Window.partitionBy("__key").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("__key").orderBy("__part").rowsBetween(1, Window.unboundedFollowing)
    scans = []
    for i, (kind, _, _) in enumerate(looks):
        s = F.col(f"__s{i}")
        if kind == "last":
            carry = F.last(F.when(s["v"].isNotNull(), s), ignorenulls=True).over(earlier)
        elif kind == "previous":
            carry = F.last(s).over(earlier)
        elif kind == "following":
            carry = F.first(s).over(later)
        else:
            carry = (F.sum if kind == "total" else F.max)(s["v"]).over(earlier)
        scans.append(carry.alias(f"__c{i}"))
    carries = parts_of.select("__key", "__part", *scans)
    joined = work.join(carries, ["__key", "__part"], "left")
    own = Window.partitionBy("__key", "__part").orderBy(*[F.col(f"`{c}`") for c in (by, *ties)])
    upto = own.rowsBetween(Window.unboundedPreceding, 0)
    out = {}
    for i, (kind, name, _) in enumerate(looks):
        v, c = F.col(f"__v{i}"), F.col(f"__c{i}")
        if kind == "last":
            out[name] = F.coalesce(F.last(v, ignorenulls=True).over(upto), c["v"])
        elif kind == "previous":
            out[name] = F.when(F.row_number().over(own) == 1, c["v"]).otherwise(F.lag(v).over(own))
        elif kind == "following":
            out[name] = F.when(F.lead(F.lit(1)).over(own).isNull(), c["v"]).otherwise(F.lead(v).over(own))
        elif kind == "total":
            here = F.sum(v).over(upto)
            out[name] = F.coalesce(here + c, here, c)
        else:
            out[name] = F.greatest(F.max(v).over(upto), c)
    return joined.withColumns(out).select(*[F.col(f"`{c}`") for c in df.columns], *[n for n in out if n not in df.columns])


def placed(df: DataFrame, key: list[str], by: str, parts: int = PARTS) -> DataFrame:
    """df dealt by key and part of the axis, with these as __key and __part: carried() takes it as it is, so several looks along one axis deal the rows once."""
    if "__part" in df.columns:
        return df
    # A struct is never null, and null fields of it are equal: a null key is a key.
    owner = F.struct(*[F.col(f"`{k}`") for k in key]) if key else F.struct(F.lit(0))
    return cut(df, by, parts).withColumn("__key", owner).repartition("__key", "__part")


def filled_forward(df: DataFrame, key: list[str], by: str, ties: list[str], value: str, name: str, parts: int = PARTS) -> DataFrame:
    """df with the last value that isn't null up to each row of its key; null before the first."""
    return carried(df, key, by, ties, last={name: F.col(f"`{value}`")}, parts=parts)


def asof_join(left: DataFrame, right: DataFrame, key: list[str], by: str, ties: list[str], right_by: str, right_ties: list[str], keep: list[str], strict: bool = False, parts: int = PARTS) -> DataFrame:
    """left with the columns keep of its key's latest row of right that is not after it, or before it where strict; nulls where there is none.

    Both sides are laid on one axis and the last row of right is carried along it, so nothing is paired. Of rows of right at one place the
    last by right_ties counts. Rows without a place have nothing before them and are before nothing; a null key is a key of its own.
    """
    rank = F.lit(1 if strict else -1)
    place = lambda df, c: number(df, c).alias("__by")
    carry = F.struct(*[F.col(f"`{c}`") for c in keep])
    a = left.select(*[F.col(f"`{k}`") for k in key], place(left, by), F.lit(0).alias("__side"), F.lit(None).cast("struct<" + ",".join(f"`{c}`:{right.schema[c].dataType.simpleString()}" for c in keep) + ">").alias("__right"), F.struct("*").alias("__left"), *[F.lit(None).cast(right.schema[c].dataType).alias(f"__t{i}") for i, c in enumerate(right_ties)])
    b = right.filter(F.col(f"`{right_by}`").isNotNull()).select(*[F.col(f"`{k}`") for k in key], place(right, right_by), rank.alias("__side"), carry.alias("__right"), F.lit(None).cast(a.schema["__left"].dataType).alias("__left"), *[F.col(f"`{c}`").alias(f"__t{i}") for i, c in enumerate(right_ties)])
    both = carried(a.unionByName(b), key, "__by", ["__side", *[f"__t{i}" for i in range(len(right_ties))]], last={"__found": F.col("__right")}, parts=parts)
    found = both.filter("__side = 0").withColumn("__found", F.when(F.col("__by").isNotNull(), F.col("__found")))
    return found.select("__left.*", *[F.col("__found")[c].alias(c) for c in keep])


def level(lo: Column, hi: Column) -> Column:
    """The power of two that is as great as the interval, or next above."""
    length = F.least(F.greatest(hi - lo, F.lit(2.0**LEAST)), F.lit(2.0**GREATEST))
    return F.greatest(F.lit(LEAST), F.least(F.lit(GREATEST), F.ceil(F.log2(length)).cast("int")))


def cell(place: Column, width: Column) -> Column:
    end = F.lit(2.0**GREATEST)
    return F.floor(F.greatest(F.least(place, end), -end) * F.pow(F.lit(2.0), -width)).cast("long")


def candidates(points: DataFrame, boxes: DataFrame, key: list[str], axes: list[tuple[str, str, str]]) -> DataFrame:
    """Points and boxes of one key that share a cell. axes: for each the point's column, and the box's for its lower and upper end, both inclusive.

    Columns of the two sides must differ but for the key. Boxes that end before they begin, and what has no place, meet nothing.
    Of the boxes' widths only which ones there are is read beforehand: one row for each, 83 an axis at most.
    """
    ends = [(number(boxes, lo), number(boxes, hi)) for _, lo, hi in axes]
    real = reduce(lambda a, b: a & b, [(lo <= hi) & ~F.isnan(lo) & ~F.isnan(hi) for lo, hi in ends])
    sized = boxes.filter(real).withColumns({f"__w{i}": level(lo, hi) for i, (lo, hi) in enumerate(ends)})
    widths = [f"__w{i}" for i in range(len(axes))]
    present = sorted(tuple(r) for r in sized.select(*widths).distinct().collect())
    entered = sized
    for i, (lo, hi) in enumerate(ends):
        entered = entered.withColumn(f"__c{i}", F.explode(F.sequence(cell(lo, F.col(f"__w{i}")), cell(hi, F.col(f"__w{i}")))))
    cells = [f"__c{i}" for i in range(len(axes))]
    places = [number(points, p) for p, _, _ in axes]
    known = reduce(lambda a, b: a & b, [p.isNotNull() & ~F.isnan(p) for p in places])
    options = F.array(*[F.struct(*[F.lit(w).alias(f"__w{i}") for i, w in enumerate(ws)]) for ws in present]) if present else F.array().cast("array<struct<" + ",".join(f"{w}:int" for w in widths) + ">>")
    looked = points.filter(known).withColumn("__at", F.explode(options)).select("*", *[F.col(f"__at.{w}").alias(w) for w in widths]).drop("__at")
    looked = looked.withColumns({c: cell(p, F.col(w)) for c, p, w in zip(cells, places, widths, strict=True)})
    return looked.join(entered, [*key, *widths, *cells]).drop(*widths, *cells)


def stab(points: DataFrame, boxes: DataFrame, key: list[str], axes: list[tuple[str, str, str]]) -> DataFrame:
    """The pairs of a point and a box of its key that holds it, ends included. See candidates()."""
    inside = reduce(lambda a, b: a & b, [F.col(f"`{p}`").between(F.col(f"`{lo}`"), F.col(f"`{hi}`")) for p, lo, hi in axes])
    return candidates(points, boxes, key, axes).filter(inside)


def meeting(a: DataFrame, b: DataFrame, key: list[str], a_ends: tuple[str, str], b_ends: tuple[str, str]) -> DataFrame:
    """The pairs of intervals of one key that meet, ends included, each once: b begins within a, or a begins within b and after it."""
    real = lambda df, lo, hi: df.filter(F.col(f"`{lo}`") <= F.col(f"`{hi}`"))
    a, b = real(a, *a_ends), real(b, *b_ends)
    first = stab(b, a, key, [(b_ends[0], *a_ends)])
    later = stab(a, b, key, [(a_ends[0], *b_ends)]).filter(F.col(f"`{a_ends[0]}`") > F.col(f"`{b_ends[0]}`"))
    return first.unionByName(later)
