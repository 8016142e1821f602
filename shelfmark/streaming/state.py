"""Tables that a stream keeps: what is known of each key, merged batch by batch, each batch once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.plans.publish import Store


class StateTable:
    """The latest row of each key. A version is written whole and becomes current by one rename; its name says which batch made it.

    A batch that is merged twice, after a crash at whatever point, changes nothing the second time: the current version's batch is
    a fence. Sized for one row a key (a store and its fingerprint); every merge writes all of them.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, order: str, lease: float = 6 * 3600.0):
        self.store, self.key, self.order = Store(spark, root, lease), key, order

    def batch(self) -> int:
        """The last batch that was merged, -1 before the first."""
        name = self.store.current_id()
        return int(name.split("-")[1]) if name else -1

    def read(self) -> DataFrame | None:
        return self.store.current()

    def merge(self, rows: DataFrame, batch_id: int, fault: Callable[[str], None] = lambda _: None) -> bool:
        """Merges rows of the same columns: of a key's rows, old and new, the one that is greatest by order stays; of equals the greatest row. False if the batch was merged before.

        Rows without a key are left out.
        """
        if batch_id <= self.batch():
            return False
        old = self.read()
        every = rows if old is None else old.unionByName(rows.select(*old.columns))
        whole = F.struct(*[F.col(self.order).alias("__order"), *[F.col(c) for c in every.columns]])
        latest = every.filter(F.col(self.key).isNotNull()).groupBy(self.key).agg(F.max(whole).alias("__w"))
        kept = latest.select(*[F.col(f"__w.{c}").alias(c) for c in every.columns])
        self.store.publish(kept, lambda _: [], fault, f"snapshot-{batch_id}")
        fault("after_publish")
        return True

    def sink(self, fault: Callable[[str], None] = lambda _: None) -> Callable[[DataFrame, int], None]:
        """For foreachBatch."""
        return lambda rows, batch_id: [self.merge(rows, batch_id, fault), None][1]

    def changed(self, now: DataFrame, value: str) -> DataFrame:
        """(key, before, after): keys whose value (a fingerprint) is not what is stored, new and gone ones too."""
        old = self.read()
        a = now.select(self.key, F.col(value).alias("after"))
        b = (old if old is not None else now.limit(0)).select(self.key, F.col(value).alias("before"))
        return a.join(b, self.key, "full").filter(~F.col("before").eqNullSafe(F.col("after"))).select(self.key, "before", "after")
