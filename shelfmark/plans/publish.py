"""Publication: a staged snapshot passes its gate and becomes current in one step, or nothing changes.

A snapshot is written to a folder of its own. What is current is said by one small
pointer file, replaced by a rename; until then readers see the old snapshot, and a
failure at any point leaves it in place.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfmark.operators import gates

#: Seconds that a writer may take, from its lock to its pointer; a lock older than that was left by a crash.
LEASE = 6 * 3600.0


class GateError(Exception):
    """A staged snapshot that must not be published."""


class Busy(Exception):
    """Another writer is at work: there is one at a time."""


class Store:
    """Snapshots under one root, which driver and executors share."""

    def __init__(self, spark: SparkSession, root: str, lease: float = LEASE):
        self.spark, self.root, self.lease = spark, root, lease
        jvm = spark.sparkContext._jvm
        self.path = jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _read(self, name: str) -> str | None:
        p = self.path(f"{self.root}/{name}")
        if not self.fs.exists(p):
            return None
        stream = self.fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _replace(self, name: str, text: str) -> None:
        new, old = self.path(f"{self.root}/.{name}-{uuid.uuid4().hex}"), self.path(f"{self.root}/{name}")
        stream = self.fs.create(new, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = self.spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        option = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        options = self.spark.sparkContext._gateway.new_array(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = option
        context.rename(new, old, options)

    def current_id(self) -> str | None:
        return self._read("current")

    def current(self) -> DataFrame | None:
        name = self.current_id()
        return self.spark.read.parquet(f"{self.root}/{name}") if name else None

    def publish(self, rows: DataFrame, gate: Callable[[DataFrame], list[str]], fault: Callable[[str], None] = lambda _: None, called: str = "snapshot") -> str:
        """Writes the snapshot, reads it back for the gate, and points to it. fault is called at each step, for tests; called begins the name."""
        name = f"{called}-{uuid.uuid4().hex}"
        staged = f"{self.root}/{name}"
        self._lock(name)
        try:
            rows.write.parquet(staged)
            fault("after_write")
            if errors := gate(self.spark.read.parquet(staged)):
                raise GateError("; ".join(errors))
            fault("after_gate")
            if self._holder() != name:
                raise Busy("the lock was taken over: this writer was silent for too long")
            before = self.current_id()
            self._replace("current", name)
        except BaseException:
            self.fs.delete(self.path(staged), True)
            raise
        finally:
            if self._holder() == name:
                self.fs.delete(self.path(f"{self.root}/.lock"), False)
        self._clean({name, before})
        return name

    def _holder(self) -> str | None:
        text = self._read(".lock")
        return text.split(" ")[0] if text else None

    def _lock(self, owner: str) -> None:
        """Takes the lock, which says who has it since when. One whose holder was silent for longer than a lease is left by a crash: it is moved away, by one writer only."""
        lock = self.path(f"{self.root}/.lock")
        for _ in range(2):
            try:
                stream = self.fs.create(lock, False)
                stream.write(bytearray(f"{owner} {time.time():.0f}".encode()))
                stream.close()
                return
            except Exception as e:
                try:
                    age = time.time() - self.fs.getFileStatus(lock).getModificationTime() / 1000
                except Exception:  # gone in the meantime
                    continue
                if age <= self.lease:
                    raise Busy(f"another writer holds {lock}") from e
                away = self.path(f"{self.root}/.stale-{owner}")
                if self.fs.rename(lock, away):
                    self.fs.delete(away, False)
        raise Busy(f"another writer holds {lock}")

    def _clean(self, keep: set[str | None]) -> None:
        """Snapshots but for the current one and the one before it, which readers may still have open."""
        for status in self.fs.listStatus(self.path(self.root)):
            name = status.getPath().getName()
            if name.startswith("snapshot-") and name not in keep and time.time() - status.getModificationTime() / 1000 > self.lease:
                self.fs.delete(status.getPath(), True)


def update(store: Store, old_fingerprints: DataFrame, new_fingerprints: DataFrame, extract: Callable[[], DataFrame], gate: Callable[[DataFrame], list[str]]) -> str:
    """unchanged, or published: nothing is extracted while every store's fingerprint stays and the current snapshot passes.

    Fingerprints are tables (store_id, fingerprint), such as streaming.state keeps; a store without one is always looked at anew.
    """
    now = store.current()
    same = gates.same_maps(old_fingerprints, new_fingerprints, "store_id", "fingerprint").first()["unchanged"]
    if same and now is not None and not gate(now):
        return "unchanged"
    store.publish(extract(), gate)
    return "published"
