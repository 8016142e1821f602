"""The best of several candidates, its lead over the next, and what variants agree on: aggregates, combined before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best(df: DataFrame, keys: list[str], order: list[Column], keep: list[str]) -> DataFrame:
    """Of each key the row that is greatest in order: keys and the columns to keep."""
    top = F.max_by(F.struct(*keep), F.struct(*[c.alias(f"o{k}") for k, c in enumerate(order)])).alias("__best")
    return df.groupBy(*keys).agg(top).select(*keys, *[F.col(f"__best.{c}").alias(c) for c in keep])


def lead(df: DataFrame, keys: list[str], order: list[Column], score: str, keep: list[str]) -> DataFrame:
    """Of each key the first row in order (keep), its score as top, and margin: how much more that is than the second's, or than 0."""
    two = df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("__rn <= 2")  # limited below the shuffle
    fields = list(dict.fromkeys([score, *keep]))
    by = two.groupBy(*keys).agg(*[F.max(F.when(F.col("__rn") == k, F.struct(*fields))).alias(f"__{k}") for k in (1, 2)])
    top = F.col(f"__1.{score}")
    return by.select(*keys, *[F.col(f"__1.{c}").alias(c) for c in keep], top.alias("top"), (top - F.coalesce(F.col(f"__2.{score}"), F.lit(0.0))).alias("margin"))


def consensus(df: DataFrame, keys: list[str], variant: str, order: list[Column], least: int) -> DataFrame:
    """Of each key that is seen in at least so many variants: the variants in order, the one of the best evidence, and how many rows there are.

    Variants are held as a set for each key, so they should be few.
    """
    top = F.max_by(variant, F.struct(*[c.alias(f"o{k}") for k, c in enumerate(order)]))
    found = df.groupBy(*keys).agg(F.array_sort(F.collect_set(variant)).alias("variants"), top.alias("best"), F.count(F.lit(1)).alias("n"))
    return found.filter(F.size("variants") >= least)


def extent(df: DataFrame, keys: list[str], middle: str, along: str) -> DataFrame:
    """The exact median of one measure of each key, and the least and greatest of another."""
    return df.groupBy(*keys).agg(F.median(middle).alias("middle"), F.min(along).alias("lo"), F.max(along).alias("hi"))
