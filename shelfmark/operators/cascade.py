"""A cascade of readings: each is tried on what those before it left unresolved, and on no more."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.stored import Table

#: Takes the rows that are left; returns (key, values) of those that it resolves.
Reading = Callable[[DataFrame], DataFrame]


def cascade(rows: DataFrame, key: str, readings: list[tuple[str, Reading]]) -> tuple[DataFrame, list[tuple[str, int]]]:
    """(rows with what the first reading that resolves their key made of them and its name, how many rows each reading was given).

    A reading runs on the rows that no earlier one resolved, from a stored table, and the cascade ends when none is left: a dear reading
    at the end sees few rows, or never runs. A reading that gives several rows for a key is taken by its least; what it says of other
    keys than those it was given counts for nothing. Rows that are never resolved have nulls; a null key is never resolved. Rows of one key are resolved together.
    """
    left, given, found = Table(rows, "unresolved"), [], []
    for name, reading in readings:
        n = left.read().count()
        if n == 0:
            break
        given.append((name, n))
        read = reading(left.read())
        values = [c for c in read.columns if c != key]
        one = read.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*values)).alias("__v")).select(key, *[F.col(f"__v.{c}").alias(c) for c in values])
        own = one.join(left.read().select(key).distinct(), key, "left_semi").withColumn("reading", F.lit(name))
        done = Table(own, "resolved")
        found.append(done)
        rest = Table(left.read().join(done.read().select(key), key, "left_anti"), "unresolved")
        left.drop()
        left = rest
    if not found:
        return rows.withColumn("reading", F.lit(None).cast("string")), given
    every = reduce(lambda a, b: a.unionByName(b), [t.read() for t in found])
    return rows.join(every, key, "left"), given
