"""Relations as sets and as bags."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def bag_counts(expected: DataFrame, got: DataFrame, keys: list[str]) -> DataFrame:
    """Per value how often each side has it: one aggregate in place of intersectAll and exceptAll."""
    sides = [df.select(*keys, F.lit(e).alias("__expected"), F.lit(1 - e).alias("__got")) for df, e in ((expected, 1), (got, 0))]
    return sides[0].unionByName(sides[1]).groupBy(*keys).agg(F.sum("__expected").alias("expected"), F.sum("__got").alias("got"))


def recall(expected: DataFrame, got: DataFrame, keys: list[str], by: list[str] | None = None) -> DataFrame:
    """matched, expected, recall: each expected value needs a find of its own; nothing expected is a recall of 1."""
    c = bag_counts(expected, got, [*(by or []), *keys])
    out = c.groupBy(*(by or [])).agg(F.coalesce(F.sum(F.least("expected", "got")), F.lit(0)).alias("matched"), F.coalesce(F.sum("expected"), F.lit(0)).alias("expected"))
    return out.withColumn("recall", F.when(F.col("expected") > 0, F.col("matched") / F.col("expected")).otherwise(1.0))


def replaced(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The old rows of keys that the new issue doesn't have, and all new rows: an issue replaces its store's rows, it never adds."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def ordered_union(parts: list[DataFrame], keys: list[str], order: str) -> DataFrame:
    """The rows of all parts, each key once: where it comes first, by part and then by order. part and order tell the place."""
    every = None
    for k, part in enumerate(parts):
        numbered = part.withColumn("part", F.lit(k))
        every = numbered if every is None else every.unionByName(numbered)
    first = F.min(F.struct("part", order, *[c for c in parts[0].columns if c not in (*keys, order)])).alias("__f")  # combined before the shuffle
    return every.groupBy(*keys).agg(first).select(*keys, "__f.*")


def numbered(df: DataFrame, key: str, name: str = "k", parts: int = 256) -> DataFrame:
    """df with each row's place in the order of a numeric key, from 1; equal keys are numbered in any way.

    The key's range is cut into parts at its quantiles; each part is numbered on its own and shifted by the counts
    before it, so no task sees all rows.
    """
    bounds = df.agg(F.percentile_approx(key, [k / parts for k in range(1, parts)], 10_000).alias("__bounds"))  # one row
    cut = df.crossJoin(F.broadcast(bounds)).withColumn("__part", F.size(F.filter("__bounds", lambda b: b < F.col(key)))).drop("__bounds")
    counts = cut.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))  # a row for each part
    before = counts.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    own = F.row_number().over(Window.partitionBy("__part").orderBy(key))
    return cut.join(F.broadcast(before), "__part").withColumn(name, own + F.col("__before")).drop("__part", "__before")


def zipped(a: DataFrame, a_key: str, b: DataFrame, b_key: str) -> DataFrame:
    """The k-th row of a with the k-th of b, in order of their numeric keys; no longer than the shorter."""
    return numbered(a, a_key, "__k").join(numbered(b, b_key, "__k"), "__k").drop("__k")


def zero_kept(facts: DataFrame, dimension: DataFrame, key: str, counts: dict) -> DataFrame:
    """Counts by key for every member of the dimension, 0 where there are no facts."""
    c = facts.groupBy(key).agg(*[expr.alias(n) for n, expr in counts.items()])
    return dimension.join(c, key, "left").na.fill(0, list(counts))


def same_content(a: DataFrame, b: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row, or one for each group that either has: how many rows either side has and the other hasn't, as bags."""
    counts = bag_counts(a, b, a.columns)
    more = lambda x, y: F.coalesce(F.sum(F.greatest(F.col(x) - F.col(y), F.lit(0))), F.lit(0))
    return counts.groupBy(*(by or [])).agg(more("expected", "got").alias("only_first"), more("got", "expected").alias("only_second"))


def looked_up(rows: DataFrame, held: DataFrame, key: str, name: str) -> DataFrame:
    """rows with whether their key is among those of held; each key of held counts once, a null key is never found."""
    known = held.select(key).filter(F.col(key).isNotNull()).distinct().withColumn(name, F.lit(True))
    return rows.join(known, key, "left").select(*rows.columns, F.coalesce(F.col(name), F.lit(False)).alias(name))
