"""Carries, as-of joins and stabs against plain restatements; and what their plans hold."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import cluster, ranges, spatial
from shelfmark.plans.queries import QUERIES
from tests.test_plans import plan


def rows_of(seed, n=300, keys=(1, 2, None), hot=0):
    """Few places, so that ties abound; nulls in key, place and value; a hot key where asked for."""
    r = random.Random(seed)
    out = [(k, r.choice(keys), r.choice([None, *range(40)]), r.choice([None, *range(5)])) for k in range(n)]
    return out + [(n + k, 9, r.randrange(10_000), r.choice([None, None, None, k])) for k in range(hot)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, key long, at double, v long") if rows and False else spark.createDataFrame([(a, b, None if c is None else float(c), d) for a, b, c, d in rows], "id long, key long, at double, v long")


def brute(rows):
    out = {}
    for key in {r[1] for r in rows}:
        mine = sorted((r for r in rows if r[1] == key), key=lambda r: (r[2] is not None, r[2] or 0, r[0]))
        last, total, most = None, None, None
        for i, (ident, _, _, v) in enumerate(mine):
            last = v if v is not None else last
            total = total if v is None else v + (total or 0)
            most = most if v is None else v if most is None else max(most, v)
            out[ident] = (last, mine[i - 1][3] if i else None, mine[i + 1][3] if i + 1 < len(mine) else None, total, most)
    return out


@pytest.mark.parametrize(("parts", "hot"), [(1, 0), (7, 0), (64, 400)])
def test_carries_equal_one_pass_over_each_key(spark, parts, hot):
    rows = rows_of(parts, hot=hot)
    v = F.col("v")
    got = ranges.carried(frame(spark, rows), ["key"], "at", ["id"], last={"l": v}, previous={"p": v}, following={"f": v}, total={"t": v}, most={"m": v}, parts=parts)
    assert got.columns == ["id", "key", "at", "v", "l", "p", "f", "t", "m"]
    assert {r["id"]: tuple(r)[4:] for r in got.collect()} == brute(rows)


def test_carries_on_odd_tables(spark):
    v = F.col("v")
    assert ranges.filled_forward(frame(spark, []), ["key"], "at", ["id"], "v", "l").collect() == []
    rows = [(1, None, None, None), (2, None, None, 5), (3, 1, 2.0, 7), (3, 1, 2.0, 7), (4, 1, float("nan"), None)]
    got = ranges.carried(spark.createDataFrame(rows, "id long, key long, at double, v long"), ["key"], "at", ["id"], last={"l": v}, total={"t": v}, parts=3)
    assert sorted((r["id"], r["l"], r["t"]) for r in got.collect() if r["id"] > 1) == [(2, 5, 5), (3, 7, 7), (3, 7, 14), (4, 7, 14)]


def test_dates_and_times_have_an_order(spark):
    days = [(k, 1, datetime(2024, 1, 1) + timedelta(hours=k * 7), None if k % 3 else k) for k in range(40)]
    df = spark.createDataFrame(days, "id long, key long, at timestamp, v long")
    for kind in ("timestamp", "timestamp_ntz"):
        got = ranges.filled_forward(df.withColumn("at", F.col("at").cast(kind)), ["key"], "at", ["id"], "v", "l", parts=5)
        assert {r["id"]: r["l"] for r in got.collect()} == {k: k - k % 3 for k in range(40)}


def windows(df):
    return [x for x in plan(df).splitlines() if "Window [" in x or "Window(" in x]


@pytest.mark.parametrize("name", ["filled_forward", "gap_sessionize", "sticky_gap", "asof_order"])
def test_no_window_holds_a_key(spark, sf, name):
    """Windows are of parts of a key, or of summaries of parts, which are aggregates."""
    p = plan(QUERIES[name](spark, sf)).splitlines()
    found = [k for k, x in enumerate(p) if "Window [" in x]
    whole = [k for k in found if "__part" not in p[k].split("], [")[1]]
    assert found and whole and all(any("Aggregate(" in x and "__part" in x for x in p[k : k + 7]) for k in whole)


def test_a_hot_key_is_spread(spark):
    """100,000 rows of one key: no part has more than a few hundredths of them, and a part gives one summary."""
    df = spark.range(100_000).select(F.lit(1).alias("key"), F.col("id"), (F.col("id") * F.col("id") % 99991).cast("double").alias("at"))
    sizes = [r["count"] for r in ranges.cut(df, "at").groupBy("key", "__part").count().collect()]
    assert len(sizes) > 50 and max(sizes) < 0.04 * 100_000
    g = cluster.gap_groups(df.filter("at % 1000 < 900"), ["key"], "at", ["id"], 50)
    assert g.select(F.max("group")).first()[0] == 99


@pytest.mark.parametrize("strict", [False, True])
def test_asof_join_equals_a_search(spark, strict):
    r = random.Random(strict)
    left = [(k, r.choice([1, 2, 3, None]), r.choice([None, *range(30)])) for k in range(150)]
    right = [(k, r.choice([1, 2, None]), r.choice([None, *range(30)]), r.choice([None, k])) for k in range(60)]
    a = spark.createDataFrame([(i, k, None if t is None else float(t)) for i, k, t in left], "id long, key long, at double")
    b = spark.createDataFrame([(i, k, None if t is None else float(t), v) for i, k, t, v in right], "rid long, key long, rat double, v long")
    want = {}
    for i, k, t in left:
        able = [(rt, rid, v) for rid, rk, rt, v in right if rk == k and None not in (t, rt) and (rt < t or (rt == t and not strict))]
        want[i] = max(able, key=lambda x: x[:2])[1:] if able else (None, None)
    got = ranges.asof_join(a, b, ["key"], "at", ["id"], "rat", ["rid"], ["rid", "v"], strict=strict, parts=5)
    assert got.columns == ["id", "key", "at", "rid", "v"] and {x["id"]: (x["rid"], x["v"]) for x in got.collect()} == want
    assert ranges.asof_join(a, b.filter("false"), ["key"], "at", ["id"], "rat", ["rid"], ["rid"]).filter("rid IS NULL").count() == 150
    assert ranges.asof_join(a.filter("false"), b, ["key"], "at", ["id"], "rat", ["rid"], ["rid"]).count() == 0


def test_stab_and_meeting_equal_all_pairs(spark):
    r = random.Random(8)
    place = lambda: r.choice([None, float("nan"), *[r.uniform(-50, 50) for _ in range(30)], *map(float, range(-5, 5))])
    points = [(k, r.choice([1, 2, None]), place(), place()) for k in range(200)]
    boxes = []
    for k in range(120):
        x, y = place(), place()
        boxes.append((k, r.choice([1, 2, None]), x, None if x is None else x + r.choice([0.0, 0.001, 1.0, 8.0, 300.0, -1.0]), y, None if y is None else y + r.choice([0.0, 2.0, 64.0, 1e9])))
    p = spark.createDataFrame(points, "p long, key long, x double, y double")
    b = spark.createDataFrame(boxes, "b long, key long, x1 double, x2 double, y1 double, y2 double")
    inside = lambda v, lo, hi: None not in (v, lo, hi) and lo <= v <= hi
    one = sorted((i, j) for i, k, x, _ in points for j, q, lo, hi, *_ in boxes if k is not None and k == q and inside(x, lo, hi))
    assert sorted((z["p"], z["b"]) for z in ranges.stab(p, b, ["key"], [("x", "x1", "x2")]).collect()) == one and one
    two = sorted((i, j) for i, k, x, y in points for j, q, lo, hi, lo2, hi2 in boxes if k is not None and k == q and inside(x, lo, hi) and inside(y, lo2, hi2))
    assert sorted((z["p"], z["b"]) for z in ranges.stab(p, b, ["key"], [("x", "x1", "x2"), ("y", "y1", "y2")]).collect()) == two and two
    other = b.select(F.col("b").alias("c"), "key", F.col("y1").alias("z1"), F.col("y2").alias("z2"))
    real = lambda lo, hi: None not in (lo, hi) and lo <= hi
    meet = sorted((i, j) for i, k, lo, hi, *_ in boxes for j, q, _, _, a, c in boxes if k is not None and k == q and real(lo, hi) and real(a, c) and lo <= c and a <= hi)
    assert sorted((z["b"], z["c"]) for z in ranges.meeting(b.drop("y1", "y2"), other, ["key"], ("x1", "x2"), ("z1", "z2")).collect()) == meet and meet
    for p_, b_ in ((p.filter("false"), b), (p, b.filter("false"))):
        assert ranges.stab(p_, b_, ["key"], [("x", "x1", "x2")]).count() == 0


def test_few_candidates_on_one_hot_key(spark):
    """Intervals of all lengths from a thousandth to ten thousand on one key: at most three candidates to a pair."""
    n = 3000
    u = lambda seed: F.rand(seed)
    points = spark.range(n).select(F.lit(1).alias("key"), F.col("id").alias("p"), (u(1) * 10_000).alias("x"))
    boxes = spark.range(n).select(F.lit(1).alias("key"), F.col("id").alias("b"), (u(2) * 10_000).alias("lo"), F.pow(F.lit(10.0), u(3) * 7 - 3).alias("len")).select("key", "b", "lo", (F.col("lo") + F.col("len")).alias("hi"))
    points, boxes = (spark.createDataFrame(df.collect(), df.schema) for df in (points, boxes))
    axes = [("x", "lo", "hi")]
    met, found = ranges.candidates(points, boxes, ["key"], axes).count(), ranges.stab(points, boxes, ["key"], axes).count()
    assert found > 100_000 and met <= 3 * found


@pytest.mark.parametrize("name", ["point_in_region", "token_in_cell_topk", "slot_texts", "overlap_neighbourhood", "nearest_separator", "left_neighbour"])
def test_range_joins_meet_in_cells(spark, sf, name):
    joins = [x for x in plan(QUERIES[name](spark, sf)).splitlines() if "Join" in x]
    assert any("__c0" in x for x in joins) and not any("NestedLoop" in x and "Cross" not in x for x in joins)


def test_separators_between_many_gaps(spark):
    """One key with as many gaps as lines: 2,000 by 2,000 would be 4,000,000 pairs."""
    gaps = spark.range(2000).select(F.lit(1).alias("k"), F.col("id").alias("gap"), F.col("id").cast("double").alias("lo"), (F.col("id") + 1.0).alias("hi"), (F.col("id") + 0.5).alias("target"))
    lines = spark.range(2000).select(F.lit(1).alias("k"), (F.col("id") + 0.25).alias("pos"), (F.col("id") % 7 + 1).alias("length"))
    assert spatial.nearest_separator(gaps, lines, "k", "gap").filter("separator <> gap + 0.25").count() == 0
    assert ranges.candidates(lines, gaps, ["k"], [("pos", "lo", "hi")]).count() <= 3 * 2000


def test_many_templates_meet_in_tiles(spark, monkeypatch):
    r = random.Random(1)
    vectors = spark.createDataFrame([(k, [r.random() for _ in range(3)]) for k in range(40)], "id long, v array<double>")
    templates = spark.createDataFrame([(f"t{k}", [r.choice([0.0, 0.5, 1.0]) for _ in range(3)]) for k in range(25)], "label string, t array<double>")
    run = lambda: spatial.nearest_template(vectors, templates, F.col("v"), F.col("t"), ["id"], "label")
    few = run()
    monkeypatch.setattr(spatial, "TEMPLATES", 10)
    many = run()
    assert "CartesianProduct" not in plan(many) and "NestedLoop" not in plan(many)
    assert sorted(map(tuple, few.select("id", "label").collect())) == sorted(map(tuple, many.select("id", "label").collect()))
