"""Windows with a table for late rows, replayed in and out of order."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest

from shelfmark.streaming import late, updates

SCHEMA = "key string, ts timestamp, value double, id long"
START, WIDTH = datetime(2024, 1, 1), 600


def replay(spark, tmp_path, files):
    for k, rows in enumerate(files):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/{k:03}")
    before = spark.conf.get(late.ROCKS[0])
    spark.conf.set(*late.ROCKS)
    closed, gone = [], []
    try:
        source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        out = late.windows_and_late(source, "key", "ts", "value", WIDTH, "10 minutes")
        sink = late.dealt(lambda df, _: closed.extend(map(tuple, df.collect())), lambda df, _: gone.extend(map(tuple, df.collect())))
        updates.run_available(out, f"{tmp_path}/checkpoint", sink)
    finally:
        spark.conf.set(late.ROCKS[0], before)
    return closed, gone


def batch(rows):
    """The windows of all rows, as a batch has them."""
    n, total = Counter(), Counter()
    for key, ts, value, _ in rows:
        if ts is not None:
            w = (key or "", START + timedelta(seconds=int((ts - START).total_seconds()) // WIDTH * WIDTH))
            n[w] += 1
            total[w] += value or 0.0
    return sorted((*w, n[w], total[w]) for w in n)


def events():
    r = random.Random(2)
    rows = [(r.choice(["a", "b", None]), START + timedelta(seconds=20 * k), r.choice([None, 1.0, 2.5]), k) for k in range(300)]
    return rows + [("a", None, 1.0, -1)]


@pytest.fixture
def end():
    """An event far ahead closes all windows."""
    return [("z", START + timedelta(days=3), 0.0, 999)]


def test_out_of_order_within_the_lateness_equals_the_batch(spark, tmp_path, end):
    rows, r = events(), random.Random(5)
    moved = sorted((x for x in rows if x[1]), key=lambda x: x[1] + timedelta(seconds=r.uniform(0, 500)))
    files = [[*moved[k : k + 60], rows[-1]] for k in range(0, 300, 60)]
    closed, gone = replay(spark, tmp_path, [*files, end, end])
    assert gone == [] and sorted(closed) == batch(rows)


def test_late_rows_are_counted_in_their_own_table(spark, tmp_path, end):
    rows = [x for x in events() if x[1]]
    held = rows[10:40]  # come an hour after their windows were closed
    others = [x for x in rows if x not in held]
    closed, gone = replay(spark, tmp_path, [others[:200], others[200:], held, end, end])
    assert sorted(closed) == batch(others)
    assert sorted(gone) == batch(held)
    assert sum(c[2] for c in closed) + sum(g[2] for g in gone) == len(rows)
