"""Record topics: Kafka, or folders of Parquet files with the same columns.

A sorted topic holds one complete copy per run. Each run writes its copy under
its own name, and readers take one run, so a second run adds to no older copy.
When all copies of a run are there it is noted as complete, with its numbers of
records; readers take the last one noted unless they are told another.

All give (topic, partition, offset, value, run). The Kafka connector is not part
of a plain Spark installation: its rules are tested on its rows kept as files
(``ArchivedTopics``), the calls that load and save them are not.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators.positions import _ROW_IN_PARTITION
from tallyline.session import write_table
from tallyline.sources.lines import folder_bytes, folder_names, path_exists

MESSAGE_SCHEMA = "topic string, partition int, offset long, value string"
ARCHIVE_SCHEMA = "topic string, partition int, offset long, value binary, headers array<struct<key string, value binary>>"

# The source topic, the broker used when KAFKA_BROKER is unset,
# the size one record is taken to have where none has been measured, and the
# largest message. A longer one fails the job; none is dropped.
SOURCE_TOPIC = "source"
DEFAULT_BROKER = "localhost:9092"
RECORD_BYTES = 50
MAX_MESSAGE_BYTES = 10 * 1024 * 1024
# Where complete runs are noted: a folder of file topics, a topic of Kafka.
RUNS = "complete-runs"
RUNS_TOPIC = "complete-runs"


def broker() -> str:
    return os.environ.get("KAFKA_BROKER") or DEFAULT_BROKER


def kafka_source_options(
    topics: Sequence[str],
    bootstrap: str | None = None,
    batch_bytes: int | None = None,
    flush_interval: float | None = None,
    record_bytes: float = RECORD_BYTES,
) -> dict[str, str]:
    """A micro-batch is cut at ``batch_bytes`` or, if that is not reached, after ``flush_interval`` seconds.

    Kafka limits batches by records, so the bytes are those of records of ``record_bytes``.
    """
    options = {
        "kafka.bootstrap.servers": bootstrap or broker(),
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
        "kafka.max.partition.fetch.bytes": str(MAX_MESSAGE_BYTES),
    }
    if batch_bytes:
        options["maxOffsetsPerTrigger"] = str(max(1, int(batch_bytes / record_bytes)))
        if flush_interval:
            options["minOffsetsPerTrigger"] = options["maxOffsetsPerTrigger"]
            options["maxTriggerDelay"] = f"{int(flush_interval * 1000)}ms"
    return options


def kafka_sink_options(topic: str, bootstrap: str | None = None) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": bootstrap or broker(),
        "topic": topic,
        "kafka.compression.type": "lz4",
        "kafka.max.request.size": str(MAX_MESSAGE_BYTES),
        # Records of one task must not overtake each other on a resend.
        "kafka.enable.idempotence": "true",
    }


def new_run_id() -> str:
    """Later runs have greater names."""
    return f"{time.time_ns():020d}"


def latest_run(runs: Mapping[str, Mapping[str, int]]) -> str | None:
    """The last of the complete runs."""
    return max(runs, default=None)


def _header(name: str) -> Column:
    found = F.filter("headers", lambda h: h["key"] == name)
    return F.get(found, F.lit(0))["value"].cast("string")


def message_columns(df: DataFrame, run: str | None = None) -> DataFrame:
    """(topic, partition, offset, value, run) of the connector's rows.

    A record of a run has the place it was given by the sort: the task that
    sent it and its number there. A task that ran twice has sent its records
    twice; they have the same place, and whoever restores the order keeps one.
    Without a ``run``, records of all runs and of none are given.
    """
    own = df.select("topic", "partition", "offset", F.col("value").cast("string").alias("value"), _header("run").alias("run"), _header("seq").cast("bigint").alias("seq"))
    sorted_ = F.col("run").isNotNull() & F.col("seq").isNotNull()
    placed = own.select(
        "topic",
        F.when(sorted_, F.shiftright("seq", 33).cast("int")).otherwise(F.col("partition")).alias("partition"),
        F.when(sorted_, F.col("seq").bitwiseAND(F.lit(_ROW_IN_PARTITION))).otherwise(F.col("offset")).alias("offset"),
        "value",
        "run",
    )
    return placed if run is None else placed.where(F.col("run") == run)


@dataclass(frozen=True)
class KafkaTopics:
    """Topics of a broker.

    A run is complete once a record that says how many it has on each topic is
    on the topic ``RUNS_TOPIC``, which readers look at first. Until then its
    records are there but are no run that anyone reads by default.
    """

    # Partitions of a sorted topic; the topics must have been made with as
    # many. The sort spreads over as many tasks as its data needs: a number
    # that goes with each record keeps the order.
    topic_partitions: int
    # A sort reads its input twice: to place the boundaries and to move the
    # rows. What the broker sends is landed first so that it sends it once.
    cheap_to_read_again = False
    bootstrap: str | None = None
    extra: dict[str, str] = field(default_factory=dict)

    def _load(self, spark: SparkSession, options: dict[str, str], stream: bool = False) -> DataFrame:
        """Rows as the connector gives them, with headers."""
        reader = spark.readStream if stream else spark.read
        return reader.format("kafka").options(**options, **self.extra, includeHeaders="true").load()

    def _save(self, rows: DataFrame, options: dict[str, str]) -> None:
        rows.write.format("kafka").options(**options, **self.extra, includeHeaders="true").save()

    def stream(
        self,
        spark: SparkSession,
        topics: Sequence[str],
        batch_bytes: int | None = None,
        flush_interval: float | None = None,
        run: str | None = None,
        record_bytes: float = RECORD_BYTES,
    ) -> DataFrame:
        options = kafka_source_options(topics, self.bootstrap, batch_bytes, flush_interval, record_bytes)
        return message_columns(self._load(spark, options, stream=True), run)

    def read(self, spark: SparkSession, topics: Sequence[str], run: str | None = None) -> DataFrame:
        return message_columns(self._load(spark, kafka_source_options(topics, self.bootstrap)), run)

    def write(self, df: DataFrame, topic: str) -> None:
        self._save(df.select(F.col("raw").alias("value")), kafka_sink_options(topic, self.bootstrap))

    def write_ordered(self, ordered: DataFrame, topic: str, run: str) -> None:
        self._save(ordered_rows(ordered, run, self.topic_partitions), kafka_sink_options(topic, self.bootstrap))

    def complete(self, spark: SparkSession, run: str, records: Mapping[str, int]) -> None:
        """Note that all copies of a run are there, and how many records each has."""
        note = json.dumps({"run": run, "records": dict(records)})
        self._save(spark.createDataFrame([(note,)], "value string"), kafka_sink_options(RUNS_TOPIC, self.bootstrap))

    def complete_runs(self, spark: SparkSession) -> dict[str, dict[str, int]]:
        """Records by topic of every complete run. One short record a run."""
        notes = self._load(spark, kafka_source_options([RUNS_TOPIC], self.bootstrap)).select(F.col("value").cast("string"))
        return {n["run"]: n["records"] for n in (json.loads(r[0]) for r in notes.collect())}


def ordered_rows(ordered: DataFrame, run: str, topic_partitions: int) -> DataFrame:
    """Sorted records as Kafka rows: tasks are dealt to the topic's partitions in turn, and a number keeps the order."""
    seq = F.monotonically_increasing_id()
    header = lambda name, text: F.struct(F.lit(name).alias("key"), F.encode(text, "UTF-8").alias("value"))
    return ordered.select(
        F.pmod(F.spark_partition_id(), F.lit(topic_partitions)).alias("partition"),
        F.col("raw").alias("value"),
        F.array(header("run", F.lit(run)), header("seq", seq.cast("string"))).alias("headers"),
    )


@dataclass(frozen=True)
class ArchivedTopics(KafkaTopics):
    """Kafka rows kept as files under ``root``: a dump of topics, read and written by the very same rules.

    Each write adds a folder to its topic, with all columns the connector has.
    """

    root: str = ""

    def _load(self, spark: SparkSession, options: dict[str, str], stream: bool = False) -> DataFrame:
        topics = options["subscribe"].split(",")
        there = [f"{self.root}/{t}" for t in topics if path_exists(spark, f"{self.root}/{t}")]
        if not there:
            if stream:
                raise FileNotFoundError(f"none of the topics {topics} is under {self.root}")
            return spark.createDataFrame([], ARCHIVE_SCHEMA)
        if stream:
            names = ",".join(path.rsplit("/", 1)[1] for path in there)
            return spark.readStream.schema(ARCHIVE_SCHEMA).parquet(f"{self.root}/{{{names}}}")
        return spark.read.schema(ARCHIVE_SCHEMA).parquet(*there)

    def _save(self, rows: DataFrame, options: dict[str, str]) -> None:
        topic = options["topic"]
        nothing = F.lit(None).cast("array<struct<key:string,value:binary>>")
        first = self._load(rows.sparkSession, {"subscribe": topic}).agg(F.max("offset")).first()[0]
        place = F.monotonically_increasing_id() + F.lit(0 if first is None else first + 1)
        write_table(
            rows.select(
                F.lit(topic).alias("topic"),
                (F.col("partition") if "partition" in rows.columns else F.lit(0)).cast("int").alias("partition"),
                place.alias("offset"),
                F.col("value").cast("binary").alias("value"),
                (F.col("headers") if "headers" in rows.columns else nothing).alias("headers"),
            ),
            f"{self.root}/{topic}",
            "append",
        )


@dataclass(frozen=True)
class FileTopics:
    """Each topic is a folder under ``root``; a sorted one has a folder in it for each run."""

    root: str
    cheap_to_read_again = True

    def path(self, topic: str, run: str | None = None) -> str:
        return f"{self.root}/{topic}/run-{run}" if run else f"{self.root}/{topic}"

    def stream(
        self,
        spark: SparkSession,
        topics: Sequence[str],
        batch_bytes: int | None = None,
        flush_interval: float | None = None,
        run: str | None = None,
    ) -> DataFrame:
        # A file arrives whole, so there is nothing to wait for.
        reader = spark.readStream.schema(MESSAGE_SCHEMA).format("parquet")
        if batch_bytes:
            reader = reader.option("maxBytesPerTrigger", str(batch_bytes))
        return reader.load(self.path(f"{{{','.join(topics)}}}", run)).withColumn("run", F.lit(run).cast("string"))

    def read(self, spark: SparkSession, topics: Sequence[str], run: str | None = None) -> DataFrame:
        paths = [self.path(topic, run) for topic in topics if path_exists(spark, self.path(topic, run))]
        rows = spark.read.schema(MESSAGE_SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], MESSAGE_SCHEMA)
        return rows.withColumn("run", F.lit(run).cast("string"))

    def size(self, spark: SparkSession, topics: Sequence[str]) -> int:
        """Bytes the topics hold."""
        return sum(folder_bytes(spark, self.path(topic)) for topic in topics)

    def write(self, df: DataFrame, topic: str) -> None:
        """Add to a topic; its partitions are numbered on from those it has."""
        there = self.read(df.sparkSession, [topic]).agg(F.max("partition")).first()[0]
        self._write(df, topic, self.path(topic), 0 if there is None else there + 1)

    def write_ordered(self, ordered: DataFrame, topic: str, run: str) -> None:
        """One run's copy of a sorted topic."""
        self._write(ordered, topic, self.path(topic, run), 0)

    def _write(self, df: DataFrame, topic: str, path: str, first: int) -> None:
        # A task's rows become one topic partition, so (partition, offset)
        # gives the rows back in the order they had.
        position = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_IN_PARTITION))
        rows = df.select(
            F.lit(topic).alias("topic"),
            (F.spark_partition_id() + first).alias("partition"),
            position.alias("offset"),
            F.col("raw").alias("value"),
        )
        write_table(rows, path, "append")

    def complete(self, spark: SparkSession, run: str, records: Mapping[str, int]) -> None:
        """Note that all copies of a run are there, and how many records each has."""
        rows = spark.createDataFrame(list(records.items()), "topic string, records long").withColumn("run", F.lit(run))
        write_table(rows.coalesce(1), f"{self.root}/{RUNS}/{run}")

    def complete_runs(self, spark: SparkSession) -> dict[str, dict[str, int]]:
        """Records by topic of every complete run; unknown (empty) for runs of earlier versions."""
        names = folder_names(spark, f"{self.root}/{RUNS}")
        runs: dict[str, dict[str, int]] = {name: {} for name in names}
        if names:
            noted = spark.read.schema("topic string, records long, run string").parquet(*(f"{self.root}/{RUNS}/{name}" for name in names))
            for r in noted.where("run is not null").collect():
                runs[r["run"]][r["topic"]] = r["records"]
        return runs
