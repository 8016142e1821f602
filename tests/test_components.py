"""Components of links and of grids, votes for lines, and the cascade."""

import random

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import cascade, components, votes
from shelfmark.plans.queries import QUERIES
from tests.test_plans import plan

CELLS = "k string, x long, y long"


def brute(cells, diagonal=True):
    """Flood fill."""
    left, out = {c for c in cells if None not in c[1:]}, []
    while left:
        seed = left.pop()
        found, todo = [seed], [seed]
        while todo:
            k, x, y = todo.pop()
            for a in (-1, 0, 1):
                for b in (-1, 0, 1):
                    c = (k, x + a, y + b)
                    if c in left and (diagonal or 0 in (a, b)):
                        left.remove(c)
                        found.append(c)
                        todo.append(c)
        least = min((y, x) for _, x, y in found)
        out += [(*c, least[1], least[0]) for c in found]
    return sorted(out, key=str)


def got(spark, cells, **more):
    return sorted(map(tuple, components.grid_components(spark.createDataFrame(cells, CELLS), ["k"], "x", "y", **more).collect()), key=str)


def spiral(n):
    """One cell wide, with a gap as wide between its arms."""
    x = y = 0
    cells, (dx, dy), step = [(0, 0)], (1, 0), 2
    for turn in range(n):
        for _ in range(step):
            x, y = x + dx, y + dy
            cells.append((x, y))
        dx, dy = -dy, dx
        step += 2 if turn % 2 else 0
    return cells


def shapes():
    r = random.Random(3)
    ring = [("ring", x, y) for x in range(-5, 6) for y in range(-5, 6) if 16 <= x * x + y * y <= 30]
    dots = [("dots", 2 * x, 2 * y) for x in range(8) for y in range(8)]
    noise = [(r.choice(["n", "m", None]), r.randrange(-12, 12), r.randrange(-12, 12)) for _ in range(350)]
    corner = [("corner", 0, 0), ("corner", 1, 1), ("corner", 3, 0), ("corner", 2, 1), ("corner", 7, 7), ("far", 10**9, -(10**9))]
    return [("spiral", x, y) for x, y in spiral(14)] + ring + dots + noise + corner + [("n", None, 1), ("n", 1, None), ("corner", 0, 0)]


@pytest.mark.parametrize(("diagonal", "tile"), [(True, 4), (False, 3), (True, 64)])
def test_spirals_rings_dots_and_noise(spark, diagonal, tile):
    """In tiles of a few cells every shape crosses many seams."""
    cells = shapes()
    assert got(spark, cells, diagonal=diagonal, tile=tile) == brute(cells, diagonal)


def test_no_cells(spark):
    assert got(spark, []) == [] and got(spark, [("a", None, None)]) == []


def test_runs_of_a_tile():
    r = random.Random(5)
    for k in range(60):
        cells = sorted({(r.randrange(7), r.randrange(7)) for _ in range(r.randrange(1, 40))}, key=lambda c: (c[1], c[0]))
        first = components.runs_joined([x for x, _ in cells], [y for _, y in cells], bool(k % 2))
        want = {(x, y): (fx, fy) for _, x, y, fx, fy in brute([("k", *c) for c in cells], bool(k % 2))}
        assert [cells[f] for f in first] == [want[c] for c in cells]


def test_a_grid_of_one_key_is_spread_over_tasks(spark):
    """100,000 cells of one key, all linked: tiles of it lie in all tasks, and none holds more than its share."""
    cells = spark.range(100_000).select(F.lit("k").alias("k"), (F.col("id") % 500).alias("x"), F.floor(F.col("id") / 500).alias("y"))
    found = components.grid_components(cells, ["k"], "x", "y", tile=16)
    assert found.groupBy("least_x", "least_y").count().collect() == [(0, 0, 100_000)]
    sizes = [r["count"] for r in cells.withColumn("t", F.xxhash64(F.floor(F.col("x") / 16), F.floor(F.col("y") / 16))).repartition(8, "t").groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 40_000


def test_boxes(spark):
    cells = spark.createDataFrame([("a", 0, 0), ("a", 1, 0), ("a", 1, 1), ("a", 5, 5)], CELLS)
    boxes = components.component_boxes(components.grid_components(cells, ["k"], "x", "y"), ["k"])
    assert sorted(map(tuple, boxes.collect())) == [("a", 0, 0, 3, 0, 0, 1, 1, 0.75), ("a", 5, 5, 1, 5, 5, 5, 5, 1.0)]


def test_links_of_any_nodes(spark):
    r = random.Random(1)
    chain = [(f"c{k:03}", f"c{k + 1:03}") for k in range(99)]
    r.shuffle(chain)
    star = [("hub", f"s{k}") for k in range(50)]
    links = chain + star + star + [("x", "x"), ("p", None), (None, "q"), (None, None), ("z", "y")]
    roots = {x["node"]: x["root"] for x in components.linked(spark.createDataFrame(links, "a string, b string")).collect()}
    assert roots == {**{f"c{k:03}": "c000" for k in range(100)}, **{f"s{k}": "hub" for k in range(50)}, "hub": "hub", "x": "x", "y": "y", "z": "y"}
    assert components.linked(spark.createDataFrame([], "a long, b long")).collect() == []


def test_planted_lines_are_found_and_no_others(spark):
    r = random.Random(4)
    points = [("p", 40, y) for y in range(0, 400, 4)] + [("p", x, 300) for x in range(0, 400, 4)] + [("p", 100 + t, 20 + t) for t in range(0, 200, 3)]
    points += [("p", r.randrange(400), r.randrange(400)) for _ in range(150)] + [("q", r.randrange(400), r.randrange(400)) for _ in range(150)] + [("p", None, 3), ("q", 4, None)]
    found = votes.line_votes(spark.createDataFrame(points, CELLS), ["k"], "x", "y", angles=36, step=4, least=45).collect()
    # Upright x = 40, level y = 300, and the diagonal x - y = 80, whose normal is at three quarters of a half turn.
    assert sorted((f["k"], f["angle"], f["offset"]) for f in found) == [("p", 0, 10), ("p", 18, 75), ("p", 27, -15)]
    assert votes.line_votes(spark.createDataFrame([], CELLS), ["k"], "x", "y").count() == 0


def test_votes_equal_a_count(spark):
    r = random.Random(9)
    points = [(r.choice(["a", None]), r.randrange(-60, 60), r.randrange(-60, 60)) for _ in range(200)] * 2
    n, step, least = 8, 6, 10
    counts = {}
    for k, x, y in points:
        for a, (c, s) in enumerate(votes.directions(n)):
            o = (x * c + y * s) // (votes.UNIT * step)
            counts[k, a, o] = counts.get((k, a, o), 0) + 1
    counts = {c: v for c, v in counts.items() if v >= least}
    want = []
    for (k, a, o), v in counts.items():
        around = [(k, (a + i) % n, (o if 0 <= a + i < n else -o - 1) + j) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i, j) != (0, 0)]
        if all((v, -a, -o) > (counts[c], -c[1], -c[2]) for c in around if c in counts):
            want.append((k, a, o, v))
    got = votes.line_votes(spark.createDataFrame(points, CELLS), ["k"], "x", "y", n, step, least)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str) and len(want) > 5


def test_votes_are_summed_before_they_are_sent(spark, sf):
    p = plan(QUERIES["line_votes"](spark, sf))
    assert "partial_count" in p and p.index("Exchange hashpartitioning") < p.rindex("partial_count")


def test_cascade_equals_trying_all_on_every_row(spark):
    rows = spark.createDataFrame([(k if k % 11 else None, k) for k in range(60)] + [(6, 100), (7, 101)], "id long, v long")
    calls = []

    def reading(name, able, times=1):
        def run(left):
            calls.append(name)
            hit = left.filter(able).select("id", (F.col("v") * 10).alias("out"))
            return hit if times == 1 else hit.unionByName(hit.withColumn("out", F.col("out") + 1))

        return name, run

    readings = [reading("a", "v % 2 = 0"), reading("b", "v % 3 = 0", 2), reading("c", "v % 5 = 0 OR id = 7"), reading("d", "true"), reading("never", "true")]
    found, given = cascade.cascade(rows, "id", readings[:3])
    whole = rows.collect()
    want = {}
    for name, able in (("a", lambda i, v: v % 2 == 0), ("b", lambda i, v: v % 3 == 0), ("c", lambda i, v: v % 5 == 0 or i == 7)):
        for i in {r["id"] for r in whole if r["id"] is not None and able(r["id"], r["v"])} - set(want):
            want[i] = (min(10 * r["v"] for r in whole if r["id"] == i and able(i, r["v"])), name)
    assert sorted(map(tuple, found.select("id", "v", "out", "reading").collect()), key=str) == sorted(((r["id"], r["v"], *want.get(r["id"], (None, None))) for r in whole), key=str)
    assert [n for n, _ in given] == ["a", "b", "c"] and [c for _, c in given] == sorted((c for _, c in given), reverse=True) and given[0][1] == 62
    calls.clear()
    some, given = cascade.cascade(rows.filter("id IS NOT NULL"), "id", readings)
    assert calls == ["a", "b", "c", "d"] and some.filter("out IS NULL").count() == 0 and len(given) == 4
    empty, given = cascade.cascade(rows.limit(0), "id", readings)
    assert given == [] and empty.collect() == []
