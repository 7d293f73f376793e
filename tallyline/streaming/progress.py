"""What a run has done so far, as a table of timed rows.

While a step runs, a row is taken every few seconds and one more at its end:
records, payload bytes, records left out, and their rate since the row before.
Rows are logged and kept as a table in the run's folder.
"""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tallyline.session import write_table
from tallyline.sources.lines import path_exists

logger = logging.getLogger("tallyline")

PROGRESS_SCHEMA = (
    "step string, seq long, at double, seconds double, records long, payload_bytes long, dropped long, "
    "records_per_second double, tasks long, tasks_done long, ended boolean"
)

# Fixed value: seconds between two rows.
EVERY = 5.0
# Rows kept in memory before they are added to the table: an hour's.
HELD_ROWS = 720

Counters = Callable[[], Mapping[str, int]]


@dataclass
class Progress:
    """Rows of the steps of one run; ``path`` is a folder, or None to keep them in memory only."""

    spark: SparkSession
    path: str | None = None
    every: float = EVERY
    _rows: list[tuple] = field(default_factory=list)
    _seq: int = 0
    _lock: threading.Lock = field(default_factory=threading.Lock, repr=False)

    @contextmanager
    def step(self, name: str, counters: Counters) -> Iterator[None]:
        """Watch a step; ``counters`` gives its records, payload_bytes and dropped so far, any of them."""
        began = time.monotonic()
        before = [began, 0]
        ended = threading.Event()

        def take(end: bool) -> None:
            now, seen = time.monotonic(), counters()
            records = int(seen.get("records", 0))
            rate = (records - before[1]) / (now - before[0]) if now > before[0] else 0.0
            before[:] = now, records
            tasks, done = self._tasks()
            with self._lock:
                row = (name, self._seq, time.time(), now - began, records, int(seen.get("payload_bytes", 0)), int(seen.get("dropped", 0)), rate, tasks, done, end)
                self._seq += 1
                self._rows.append(row)
            logger.info("%s: %s records, %s dropped, %.0f a second, %s of %s tasks", name, records, row[6], rate, done, tasks)

        def watch() -> None:
            while not ended.wait(self.every):
                take(False)

        watcher = threading.Thread(target=watch, name=f"progress-{name}", daemon=True)
        watcher.start()
        try:
            yield
        finally:
            ended.set()
            watcher.join()
            take(True)
            if len(self._rows) >= HELD_ROWS:
                self.save()

    def _tasks(self) -> tuple[int, int]:
        """Tasks of the stages that run now, and how many of them are done."""
        tracker = self.spark.sparkContext.statusTracker()
        stages = [s for s in map(tracker.getStageInfo, tracker.getActiveStageIds()) if s]
        return sum(s.numTasks for s in stages), sum(s.numCompletedTasks for s in stages)

    def save(self) -> None:
        """Add the rows taken since the last call to the table."""
        with self._lock:
            rows, kept = self._rows, self.path is not None
            if kept:
                self._rows = []
        if kept and rows:
            write_table(self.spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1), self.path, "append")

    def table(self) -> DataFrame:
        """All rows so far."""
        if self.path is None:
            return self.spark.createDataFrame(self._rows, PROGRESS_SCHEMA)
        self.save()
        return read_progress(self.spark, self.path)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], PROGRESS_SCHEMA)
    return spark.read.schema(PROGRESS_SCHEMA).parquet(path)
