"""Marks of projects kept up by a stream of run reports: keyed state with event-time timers."""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# The processor travels to the executors by value: they need no copy of this library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MARKS = "project_key string, kind string, micros long"


class ProjectMarks(StatefulProcessor):
    """Per project the end of its last success, and a timer for when the next one is overdue.

    Only the latest success of a batch is kept, so a project's state is one value however many
    reports it sends.  Late and repeated reports move no mark back."""

    def __init__(self, interval_ms: int) -> None:
        self.interval_ms = interval_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.mark = handle.getValueState("mark", "micros long")  # since 1970

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        latest = max((row["micros"] for row in rows if row["is_success"] and row["micros"] is not None), default=None)
        known = self.mark.get()
        if latest is None or (known is not None and known[0] >= latest):
            return
        self.mark.update((latest,))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(latest // 1000 + self.interval_ms)
        yield Row(project_key=key[0], kind="mark", micros=latest)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        known = self.mark.get()
        if known is not None:
            yield Row(project_key=key[0], kind="overdue", micros=known[0])

    def close(self) -> None:
        pass


def project_mark_stream(reports: DataFrame, interval_minutes: int, delay: str) -> DataFrame:
    """A row of kind ``mark`` whenever a project's last success moves on, and one of kind ``overdue``
    when the watermark has passed it by the interval without another.

    ``reports`` has ``project_key``, ``end_time`` (the event time) and ``is_success``; reports
    without a project belong to none and are left out.  Whatever the micro-batches, the latest mark of
    a project is the same, and so is whether an ``overdue`` row follows it.
    """
    spark = reports.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    timed = reports.where(F.col("project_key").isNotNull()).select(
        "project_key", "end_time", "is_success", F.unix_micros("end_time").alias("micros")
    )
    told = timed.withWatermark("end_time", delay).groupBy("project_key").transformWithState(
        ProjectMarks(interval_minutes * 60_000), MARKS, "append", "eventTime"
    )
    return told.select("project_key", "kind", F.timestamp_micros("micros").alias("last_success"))


def marks_of(told: DataFrame) -> DataFrame:
    """What the stream has told, as ``project_key``, ``last_success`` and ``overdue``."""
    last = F.max(F.struct("last_success", (F.col("kind") == "overdue").alias("overdue")))
    return told.groupBy("project_key").agg(last.alias("m")).select("project_key", "m.*")
