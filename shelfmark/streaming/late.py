"""Windows that know their late rows: each row is in its window's total or in a table of late rows, never lost uncounted."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The state store that keyed state with timers needs: a setting of the session.
ROCKS = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
#: Days by which the column under the watermark is ahead of the event time, and the watermark behind it: the watermark is that of the event time, but the engine's own
#: filter, which drops late rows silently, sees none.
AHEAD = 36_500

OUT = "kind string, key string, start timestamp, n long, total double"


class Windows(StatefulProcessor):
    """For one key its open windows: rows and sum by start, in seconds. A timer at a window's end closes it; a row of a closed window is late."""

    def __init__(self, width: int):
        self.width = width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "start long", "n long, total double")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        sums: dict[int, tuple[int, float]] = {}
        for frame in rows:
            for second, value in zip(frame["second"].tolist(), frame["value"].tolist(), strict=True):
                start = second // self.width * self.width
                n, total = sums.get(start, (0, 0.0))
                sums[start] = n + 1, total + (0.0 if pd.isna(value) else value)
        late = []
        for start, (n, total) in sorted(sums.items()):
            end = (start + self.width) * 1000
            if end <= timerValues.getCurrentWatermarkInMs():
                late.append(("late", key[0], start, n, total))
            elif self.open.containsKey((start,)):
                held = self.open.getValue((start,))
                self.open.updateValue((start,), (n + held[0], total + held[1]))
            else:
                self.open.updateValue((start,), (n, total))
                self.handle.registerTimer(end)
        yield _frame(late)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        start = expiredTimerInfo.getExpiryTimeInMs() // 1000 - self.width
        n, total = self.open.getValue((start,))
        self.open.removeKey((start,))
        yield _frame([("closed", key[0], start, n, total)])

    def close(self) -> None:
        pass


def _frame(rows: list[tuple]) -> pd.DataFrame:
    shown = [(kind, key, pd.Timestamp(datetime.fromtimestamp(start, UTC)), n, total) for kind, key, start, n, total in rows]
    return pd.DataFrame(shown, columns=["kind", "key", "start", "n", "total"])


def windows_and_late(events: DataFrame, key: str, ts: str, value: str, width: int, late: str) -> DataFrame:
    """(kind, key, start, n, total) of a stream: a closed row for each key and window of width seconds, once it can have no more, and late rows, summed by
    key, window and batch. late: how far event time may lag behind its greatest value, such as '10 minutes'.

    The rows of all kinds together count every row that has come, but for windows still open. Rows without a time are left out; a null key is '', a null value is a
    row of no value. State is one row for each open window of a key and goes with the window. Needs ROCKS.
    """
    time = F.col(ts).cast("timestamp")
    shown = events.filter(F.col(ts).isNotNull()).select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"),
        F.col(value).cast("double").alias("value"),
        F.floor(F.unix_micros(time) / 1_000_000).alias("second"),
        (time + F.expr(f"INTERVAL {AHEAD} DAYS")).alias("ahead"),
    )
    return shown.withWatermark("ahead", f"{AHEAD} days {late}").groupBy("key").transformWithStateInPandas(Windows(width), OUT, "Append", "EventTime")


def dealt(closed: Callable[[DataFrame, int], None], late: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: closed windows to one table, late rows to another."""

    def sink(rows: DataFrame, batch_id: int) -> None:
        closed(rows.filter("kind = 'closed'").drop("kind"), batch_id)
        late(rows.filter("kind = 'late'").drop("kind"), batch_id)

    return sink
