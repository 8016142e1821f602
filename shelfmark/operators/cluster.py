"""Groups along an axis: by gaps (a window), and by rules that depend on what was kept before (a pass over each group)."""

from __future__ import annotations

from bisect import insort
from collections.abc import Callable, Iterator
from math import floor

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from shelfmark.operators import ranges


def gap_groups(df: DataFrame, key: list[str], by: str, ties: list[str], most: float, value: str | None = None) -> DataFrame:
    """df with group: a number that goes up where a row's value (its place on the axis by, unless another is given) is more than most above that of the row before.

    No task sees all rows of a key: see ranges.carried().
    """
    value = value or by
    stepped = ranges.carried(ranges.placed(df, key, by), key, by, ties, previous={"__before": F.col(value)})
    new = F.when(F.col(value) - F.col("__before") > most, 1).otherwise(0)
    return ranges.carried(stepped, key, by, ties, total={"group": new}).withColumn("group", F.col("group").cast("long")).drop("__before", "__key", "__part")


def sticky(df: DataFrame, key: list[str], by: str, ties: list[str], flag: Column, name: str = "sticky") -> DataFrame:
    """df with whether the flag was up in this row or any before it. No task sees all rows of a key."""
    return ranges.carried(df, key, by, ties, most={name: flag})


def _grouped(df: DataFrame, key: list[str], schema: str, f: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    return df.groupBy(*key).applyInPandas(f, schema)


class _Running:
    """A cluster's points in order, and its centre so far."""

    def __init__(self, mean: bool):
        self.mean, self.points, self.total = mean, [], 0.0

    def add(self, v: float) -> None:
        insort(self.points, v)
        self.total += v

    def centre(self) -> float:
        n = len(self.points)
        return self.total / n if self.mean else (self.points[(n - 1) // 2] + self.points[n // 2]) / 2


def running_clusters(values: list[float], most: float, mean: bool = False) -> list[int]:
    """The number of each value's cluster: the first whose median (or mean), so far, is within most; values in their given order."""
    clusters: list[_Running] = []
    out = []
    for v in values:
        k = next((k for k, c in enumerate(clusters) if abs(v - c.centre()) <= most), len(clusters))
        if k == len(clusters):
            clusters.append(_Running(mean))
        clusters[k].add(v)
        out.append(k)
    return out


def cluster_running(df: DataFrame, key: str, ident: str, pos: str, most: float, mean: bool = False) -> DataFrame:
    """(key, ident, cluster): rows in order of pos and ident; order matters, so it isn't a closure. One key's rows are held at once."""
    kinds = dict(df.dtypes)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([pos, ident])
        return pd.DataFrame({key: rows[key], ident: rows[ident], "cluster": running_clusters(rows[pos].tolist(), most, mean)})

    return _grouped(df.select(key, ident, pos), [key], f"{key} {kinds[key]}, {ident} {kinds[ident]}, cluster long", run)


def point_columns(df: DataFrame, key: str, ident: str, pos: str, most: float = 5.0, least: int = 3) -> DataFrame:
    """(key, ident, column, centre) of the points in columns: clusters by running mean with least points or more, numbered from the left."""
    points = cluster_running(df, key, ident, pos, most, mean=True).join(df.select(key, ident, pos), [key, ident])
    centres = points.groupBy(key, "cluster").agg(F.avg(pos).alias("centre"), F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= least)
    numbered = centres.withColumn("column", F.row_number().over(Window.partitionBy(key).orderBy("centre", "cluster")).cast("long"))
    return points.join(numbered, [key, "cluster"]).select(key, ident, "column", "centre")


def greedy_keep(points: list[tuple[float, float, object]], dx: float, dy: float) -> list[bool]:
    """Which points stay: those not close to an earlier one of the same value that stayed. Only the cells around a point are looked at."""
    kept: dict[tuple, list[tuple[float, float]]] = {}
    out = []
    for x, y, v in points:
        i, j = floor(x / dx), floor(y / dy)
        near = any(abs(x - a) < dx and abs(y - b) < dy for p in (i - 1, i, i + 1) for q in (j - 1, j, j + 1) for a, b in kept.get((p, q, v), ()))
        out.append(not near)
        if not near:
            kept.setdefault((i, j, v), []).append((x, y))
    return out


def greedy_dedupe(df: DataFrame, key: str, ident: str, order: list[str], value: str | None, dx: float, dy: float) -> DataFrame:
    """(key, ident) of the rows (x, y) that stay, taken in order within each key. One key's rows are held at once."""
    kinds = dict(df.dtypes)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([*order, ident])
        keep = greedy_keep(list(zip(rows["x"], rows["y"], rows[value] if value else [0] * len(rows), strict=True)), dx, dy)
        return rows.loc[keep, [key, ident]]

    return _grouped(df, [key], f"{key} {kinds[key]}, {ident} {kinds[ident]}", run)


class _LastKept:
    """A table function over the rows of one key in order: it holds the last row it kept and nothing else."""

    def __init__(self):
        self.last: tuple | None = None

    @staticmethod
    def analyze(rows: AnalyzeArgument, pos: AnalyzeArgument, value: AnalyzeArgument, within: AnalyzeArgument) -> AnalyzeResult:
        return AnalyzeResult(schema=rows.dataType)

    def eval(self, row: Row, pos: str, value: str, within: float) -> Iterator[tuple]:
        place = float("nan") if row[pos] is None else row[pos]
        if self.last is None or self.last[1] != row[value] or abs(place - self.last[0]) > within:
            self.last = (place, row[value])
            yield tuple(row)


def suppress_repeats(df: DataFrame, key: str, ident: str, pos: str, value: str, within: float) -> DataFrame:
    """(key, ident) of the rows that stay: a row goes if the last one kept has its value and is within so much of it.

    Rows come in order of pos and ident, those without a place last: these stay only where the value changes. A key's rows are streamed past the last one
    kept, so one key may have any number of them. A null value is a value, a null key a key.
    """
    kept = udtf(_LastKept)
    rows = df.select(key, ident, pos, value).asTable().partitionBy(key).orderBy(F.asc_nulls_last(pos), ident)
    return kept(rows, F.lit(pos), F.lit(value), F.lit(float(within))).select(key, ident)
