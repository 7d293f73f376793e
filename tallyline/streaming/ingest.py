"""Micro-batch ingest: topic messages become landed records, a folder per batch."""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyline.functions.records import normalise_lines, payload_bytes
from tallyline.session import write_table
from tallyline.sources.lines import path_exists
from tallyline.sources.topics import MESSAGE_SCHEMA, SOURCE_TOPIC

logger = logging.getLogger("tallyline")

LANDED_SCHEMA = "raw string, batch_id long"

AVAILABLE_NOW = {"availableNow": True}
AS_SOON_AS_POSSIBLE: dict = {}


@dataclass
class BatchLog:
    """What the batches of one run have brought so far; filled in on the driver."""

    batches: list[dict] = field(default_factory=list)
    records: int = 0
    rejected: int = 0
    started: float = field(default_factory=time.monotonic)
    last_seen: float | None = None
    busy: bool = False
    _lock: threading.Lock = field(default_factory=threading.Lock, repr=False)

    def begin(self) -> None:
        with self._lock:
            self.busy = True

    def end(self, batch_id: int | None = None, counts: dict | None = None) -> None:
        with self._lock:
            self.busy = False
            if counts is None:
                return
            self.batches.append({"batch_id": batch_id, **counts})
            self.records += counts["records"]
            self.rejected += counts["rejected"]
            if counts["records"]:
                self.last_seen = time.monotonic()

    def idle_seconds(self, arm_after_first: bool) -> float | None:
        """Seconds without a record; None while a batch runs or the clock is not armed."""
        with self._lock:
            if self.busy or (arm_after_first and self.last_seen is None):
                return None
            return time.monotonic() - (self.last_seen or self.started)

    def counters(self) -> dict:
        """What has come so far."""
        with self._lock:
            size = sum(b.get("payload_bytes", 0) for b in self.batches)
            return {"records": self.records, "payload_bytes": size, "dropped": self.rejected}

    def record_bytes(self) -> float | None:
        """Bytes of a record in the last batch that had any."""
        with self._lock:
            sizes = [b["payload_bytes"] / b["records"] for b in self.batches[-8:] if b["records"]]
        return max(1.0, sizes[-1]) if sizes else None

    def summary(self) -> dict:
        """Run counters: records, rejected, duration in seconds, records per second."""
        seconds = time.monotonic() - self.started
        return {
            "records": self.records,
            "rejected": self.rejected,
            "batches": len(self.batches),
            "seconds": seconds,
            "records_per_second": self.records / seconds if seconds else 0.0,
        }


def _start(messages: DataFrame, write, checkpoint: str, log: BatchLog, trigger: dict) -> StreamingQuery:
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        log.begin()
        counts = None
        try:
            counts = write(batch, batch_id)
        finally:
            log.end(batch_id, counts)
        logger.info("landed batch %s: %s, %s records so far", batch_id, counts, log.records)

    writer = messages.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def _counted(batch: DataFrame, accepted) -> tuple[DataFrame, Observation]:
    """Count accepted and rejected messages while the batch is written."""
    known = F.coalesce(accepted, F.lit(False))
    size = F.when(known, payload_bytes(F.coalesce("value", F.lit("")))).otherwise(F.lit(0))
    seen = Observation()
    observed = batch.observe(
        seen,
        F.count_if(known).alias("records"),
        F.coalesce(F.sum(size), F.lit(0)).alias("payload_bytes"),
        F.count_if(~known).alias("rejected"),
    )
    return observed.where(known), seen


def start_ingest(
    messages: DataFrame,
    landed: str,
    checkpoint: str,
    log: BatchLog,
    topic: str = SOURCE_TOPIC,
    trigger: dict = AVAILABLE_NOW,
) -> StreamingQuery:
    """Land the records of one topic, unparsed, as ``<landed>/batch_id=<n>``.

    A batch that is run again after a failure replaces its own folder.
    """

    def write(batch: DataFrame, batch_id: int) -> dict:
        accepted, seen = _counted(batch, F.col("topic") == topic)
        lines = normalise_lines(accepted.select("value"))
        write_table(lines, f"{landed}/batch_id={batch_id}", "overwrite")
        return seen.get

    return _start(messages, write, checkpoint, log, trigger)


def start_fanout(
    messages: DataFrame,
    landed: str,
    checkpoint: str,
    log: BatchLog,
    topics: Sequence[str],
    trigger: dict = AVAILABLE_NOW,
) -> StreamingQuery:
    """Land the messages of several topics as ``<landed>/batch_id=<n>/topic=<t>``.

    Partition and offset are kept, so the order of a topic can be restored
    however its messages were cut into batches.
    """

    def write(batch: DataFrame, batch_id: int) -> dict:
        accepted, seen = _counted(batch, F.col("topic").isin(*topics))
        write_table(accepted, f"{landed}/batch_id={batch_id}", "overwrite", ["topic"])
        return seen.get

    return _start(messages, write, checkpoint, log, trigger)


def read_landed(spark: SparkSession, landed: str) -> DataFrame:
    """(raw, batch_id) of everything landed so far; empty before the first batch."""
    if not path_exists(spark, landed):
        return spark.createDataFrame([], LANDED_SCHEMA)
    return spark.read.schema(LANDED_SCHEMA).parquet(landed)


def read_fanout(spark: SparkSession, landed: str) -> DataFrame:
    """(topic, partition, offset, value, run, batch_id) of everything landed so far.

    Records that came more than once are all here; they share a topic, run,
    partition and offset.
    """
    schema = f"{MESSAGE_SCHEMA}, run string, batch_id long"
    if not path_exists(spark, landed):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(landed)


def batch_stats(landed: DataFrame) -> DataFrame:
    """(batch_id, records, payload_bytes) of landed records."""
    return landed.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("records"), F.sum(payload_bytes(F.col("raw"))).alias("payload_bytes")
    )
