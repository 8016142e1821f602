"""Sheets of boxes, stored sketches, issues by partition, and the table function that suppresses repeats."""

import os
import random

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import cluster, sheets, sketches
from shelfmark.plans.queries import QUERIES
from shelfmark.sources import files
from tests.test_plans import plan

BOXES = "k string, id long, w long, h long"


@pytest.mark.parametrize(("width", "height", "parts"), [(40, 30, 3), (12, 9, 64)])
def test_every_box_once_within_bounds_without_overlap(spark, width, height, parts):
    r = random.Random(width)
    boxes = [(r.choice(["a", "b", None]), k, r.randint(1, 12), r.randint(1, 9)) for k in range(150)] + [("a", 900, 99, 1), ("a", 901, None, 3), ("a", 902, 0, 3)]
    layout = sheets.sheet_layout(spark.createDataFrame(boxes, BOXES), ["k"], "id", "w", "h", width, height, parts)
    rows = layout.collect()
    assert layout.columns == ["k", "id", "w", "h", "sheet", "x", "y"] and sorted((x["k"], x["id"]) for x in rows if x["k"]) == sorted((b[0], b[1]) for b in boxes if b[0])
    assert {x["id"] for x in rows if x["sheet"] is None} == {900, 901, 902}
    taken = {}
    for x in (x for x in rows if x["sheet"] is not None):
        assert x["x"] >= 0 and x["y"] >= 0 and x["x"] + x["w"] <= width and x["y"] + x["h"] <= height
        for px in range(x["x"], x["x"] + x["w"]):
            for py in range(x["y"], x["y"] + x["h"]):
                assert taken.setdefault((x["k"], x["sheet"], px, py), x["id"]) == x["id"]
    used = len({(k, s) for k, s, *_ in taken})
    assert used == len({(x["k"], x["sheet"]) for x in rows if x["sheet"] is not None}) and len(taken) > 0.25 * used * width * height
    for k in ("a", "b", None):
        numbers = {x["sheet"] for x in rows if x["k"] == k and x["sheet"] is not None}
        assert numbers == set(range(len(numbers)))
    # And back: every place of every sheet of a.
    places = spark.createDataFrame([(k, s, px, py) for k, s in {t[:2] for t in taken if t[0] == "a"} for px in range(width) for py in range(height)], "k string, sheet long, px long, py long")
    corner = {(x["k"], x["id"]): (x["x"], x["y"]) for x in rows}
    back = sheets.found_on_sheets(places, layout, ["k"], "id", "w", "h").collect()
    assert {(b["k"], b["sheet"], b["px"], b["py"]): b["id"] for b in back} == {t: i for t, i in taken.items() if t[0] == "a"}
    assert all((b["px"] - b["dx"], b["py"] - b["dy"]) == corner[b["k"], b["id"]] for b in back)


def test_no_boxes(spark):
    assert sheets.sheet_layout(spark.createDataFrame([], BOXES), ["k"], "id", "w", "h", 10, 10).collect() == []


def test_sketches_are_within_their_bounds(spark):
    """Weeks of 20,000 users each, from the days' sketches alone and in any parts."""
    e = spark.range(300_000).select((F.col("id") % 14).cast("int").alias("day"), (F.col("id") * 7919 % 20_000).alias("user"), F.when(F.col("id") % 50 > 0, F.rand(3)).alias("v"), F.lit("x").alias("k"))
    days = sketches.daily(e, F.col("day"), ["k"], "user", "v")
    halves = sketches.daily(e.filter("user < 9000"), F.col("day"), ["k"], "user", "v").unionByName(sketches.daily(e.filter("user >= 9000"), F.col("day"), ["k"], "user", "v"))
    exact = {r["w"]: r for r in e.groupBy(F.floor(F.col("day") / 7).alias("w")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user").alias("u")).collect()}
    for parts in (days, halves):
        for r in sketches.by_period(parts, F.floor(F.col("day") / 7), ["k"]).collect():
            want = exact[r["period"]]
            assert r["rows"] == want["n"] and abs(r["users"] - want["u"]) <= 4 * 0.0163 * want["u"]
            assert abs(r["sizes"][0] - 0.5) < 0.03 and abs(r["sizes"][1] - 0.9) < 0.03
    assert sketches.by_period(sketches.daily(e.filter("false"), F.col("day"), ["k"], "user", "v"), F.col("day"), ["k"]).collect() == []


def test_only_one_stores_files_are_replaced(spark, tmp_path):
    path = f"{tmp_path}/issue"
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "store_id string, v int").coalesce(1)
    files.write_issue(rows, path)
    seen = lambda: {(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if "store_id=" in d}
    before = seen()
    files.write_issue(spark.createDataFrame([("b", 9), ("d", 5)], "store_id string, v int"), path)
    after = seen()
    others = {k for k in before if "store_id=b" not in k[0]}
    assert others <= set(after) and all(before[k] == after[k] for k in others) and not {k for k in before if "store_id=b" in k[0]} & set(after)
    assert sorted(map(tuple, files.read_issue(spark, path).select("store_id", "v").collect())) == [("a", 1), ("a", 2), ("b", 9), ("c", 4), ("d", 5)]
    one = files.read_issue(spark, path, ["b"])
    assert [r["v"] for r in one.collect()] == [9] and "PartitionFilters: [isnotnull(store_id" in plan(one)
    assert files.drop_issue(spark, path, "a") and not files.drop_issue(spark, path, "a")
    assert {r["store_id"] for r in spark.read.parquet(path).collect()} == {"b", "c", "d"}
    files.write_issue(rows.filter("false"), path)
    assert spark.read.parquet(path).count() == 3 and spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_repeats_are_suppressed_past_one_held_row(spark, sf):
    r = random.Random(4)
    rows = [(r.choice([1, 2, None]), k, r.choice([None, *map(float, range(60))]), r.choice(["x", "y", None])) for k in range(300)]
    want = []
    for key in (1, 2, None):
        last = None
        for _, ident, p, v in sorted((x for x in rows if x[0] == key), key=lambda x: (x[2] is None, x[2] or 0, x[1])):
            if last is None or last[1] != v or (p is not None and last[0] is not None and abs(p - last[0]) > 5):
                last = (p, v)
                want.append((key, ident))
    df = spark.createDataFrame(rows, "k long, id long, x double, kind string")
    assert sorted(map(tuple, cluster.suppress_repeats(df, "k", "id", "x", "kind", 5.0).collect()), key=str) == sorted(want, key=str)
    assert cluster.suppress_repeats(df.filter("false"), "k", "id", "x", "kind", 5.0).collect() == []
    p = plan(QUERIES["suppress_repeats"](spark, sf))
    assert "UDTF" in p and "FlatMapGroups" not in p
