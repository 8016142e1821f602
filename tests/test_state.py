"""A table that a stream keeps: stopped at any step and run again, it ends the same."""

import pytest
from pyspark.sql import functions as F

from shelfmark.streaming import state, updates

SCHEMA = "store string, fingerprint string, seen long"
BATCHES = [[("a", "1", 1), ("b", "1", 1)], [("a", "2", 5), ("a", "0", 4), (None, "x", 9)], [("c", "1", 6), ("a", "9", 3), ("b", "1", 1)], [("b", "3", 8), ("b", "2", 8)]]
END = {("a", "2", 5), ("b", "3", 8), ("c", "1", 6)}


class Crash(Exception):
    pass


def rows(table):
    return set(map(tuple, table.read().select("store", "fingerprint", "seen").collect()))


@pytest.mark.parametrize("step", ["after_write", "after_gate", "after_publish"])
def test_a_stream_stopped_after_each_step_ends_the_same(spark, tmp_path, step):
    for k, batch in enumerate(BATCHES):
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    table = state.StateTable(spark, f"file://{tmp_path}/state", "store", "seen")
    crashes = iter([True, False, True, True, False, False, False, False, False, False])

    def fault(at):
        if at == step and next(crashes):
            raise Crash(at)

    for _ in range(8):
        source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        try:
            updates.run_available(source, f"{tmp_path}/checkpoint", table.sink(fault), "append")
        except Exception as e:
            assert "Crash" in str(e)
    assert rows(table) == END and table.batch() == 3
    before = table.store.current_id()
    assert table.merge(spark.createDataFrame([("z", "1", 99)], SCHEMA), 3) is False
    assert table.store.current_id() == before and rows(table) == END


def test_what_has_changed(spark, tmp_path):
    table = state.StateTable(spark, f"file://{tmp_path}/state", "store", "seen")
    now = spark.createDataFrame([("a", "2"), ("b", None), ("d", "1"), ("e", "5")], "store string, fingerprint string")
    assert sorted(map(tuple, table.changed(now, "fingerprint").collect()), key=str) == [("a", None, "2"), ("d", None, "1"), ("e", None, "5")]
    table.merge(spark.createDataFrame([("a", "1", 1), ("b", None, 1), ("c", "1", 1), ("d", "1", 1)], SCHEMA), 0)
    assert sorted(map(tuple, table.changed(now, "fingerprint").collect()), key=str) == [("a", "1", "2"), ("c", "1", None), ("e", None, "5")]


def test_order_of_batches_and_repeats_do_not_matter(spark, tmp_path):
    for name, order in (("one", [0, 1, 2, 3]), ("other", [3, 1, 0, 2, 2])):
        table = state.StateTable(spark, f"file://{tmp_path}/{name}", "store", "seen")
        for k, b in enumerate(order):
            assert table.merge(spark.createDataFrame(BATCHES[b], SCHEMA), k)
        assert rows(table) == END
    empty = state.StateTable(spark, f"file://{tmp_path}/empty", "store", "seen")
    assert empty.read() is None and empty.merge(spark.createDataFrame([], SCHEMA), 0) and rows(empty) == set()
    assert empty.merge(spark.createDataFrame([], SCHEMA).withColumn("seen", F.col("seen")), 1) and empty.batch() == 1
