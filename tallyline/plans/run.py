"""The three programs: generate a topic, sort it into topics, verify the outputs."""

from __future__ import annotations

import logging
import time
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyline.operators.checks import count_check, order_of_outputs, split_summaries
from tallyline.operators.generate import generate_records
from tallyline.operators.sampling import report_lines, sample_report
from tallyline.operators.sorting import SORT_KEYS, SortKey, for_each_key, global_sort
from tallyline.session import new_run_dir, scratch_removed, union_all, write_table
from tallyline.sinks.text import copy_topic_outputs, output_paths, write_report, write_topic_outputs
from tallyline.sources.topics import MAX_MESSAGE_BYTES, SOURCE_TOPIC, FileTopics, KafkaTopics, latest_run, new_run_id
from tallyline.streaming.drain import (
    FLUSH_INTERVAL,
    INGEST_IDLE,
    OUTPUT_IDLE,
    check_timeouts,
    drain,
    drain_by_measured_size,
    drain_by_size_and_clock,
    time_trigger,
)
from tallyline.streaming.ingest import (
    AS_SOON_AS_POSSIBLE,
    AVAILABLE_NOW,
    BatchLog,
    read_fanout,
    read_landed,
    start_fanout,
    start_ingest,
)
from tallyline.streaming.progress import EVERY, Progress

log = logging.getLogger("tallyline")

Topics = FileTopics | KafkaTopics

# Records of a run and bytes of a micro-batch unless told otherwise.
DEFAULT_RECORDS = 50_000_000
DEFAULT_BATCH_BYTES = 100_000_000


def generate(spark: SparkSession, topics: Topics, n: int = DEFAULT_RECORDS, seed: int = 0, workers: int | None = None) -> dict:
    """Fill the source topic; returns the run counters."""
    produced = Observation()
    started = time.monotonic()
    records = generate_records(spark, n, seed, workers)
    topics.write(records.observe(produced, F.count(F.lit(1)).alias("produced")), SOURCE_TOPIC)
    seconds = time.monotonic() - started
    count = produced.get["produced"]
    counters = {"produced": count, "seconds": seconds, "records_per_second": count / seconds if seconds else 0.0}
    log.info("generated %s", counters)
    return counters


def process(
    spark: SparkSession,
    topics: Topics,
    run_dir: str | None = None,
    expected: int | None = DEFAULT_RECORDS,
    idle_timeout: float = INGEST_IDLE,
    flush_interval: float = FLUSH_INTERVAL,
    batch_bytes: int | None = DEFAULT_BATCH_BYTES,
    available_now: bool = False,
    keys: Mapping[str, SortKey] = SORT_KEYS,
    progress_interval: float = EVERY,
) -> dict:
    """Drain the source topic, then write a sorted topic per key.

    ``available_now`` takes what is there and stops; otherwise the drain ends
    at ``expected`` records or after ``idle_timeout`` seconds without one. A
    batch is landed when there are ``batch_bytes`` for it, or else every
    ``flush_interval`` seconds. ``<run_dir>/progress`` gets a row every
    ``progress_interval`` seconds and at the end of either step.
    Given the ``run_dir`` of an earlier run, the drain carries on where that
    one stopped and everything landed by both is sorted. The copies of this
    call are a run of their own, named in the result; none is added to.
    """
    check_timeouts(idle_timeout, flush_interval)
    run_dir = run_dir or new_run_dir(spark, "run")
    batches, progress = BatchLog(), Progress(spark, f"{run_dir}/progress", progress_interval)

    def start(trigger: dict, **size: float):
        messages = topics.stream(spark, [SOURCE_TOPIC], batch_bytes, flush_interval, **size)
        return start_ingest(messages, f"{run_dir}/landed", f"{run_dir}/checkpoint", batches, trigger=trigger)

    limits = {} if available_now else {"until_count": expected, "idle_timeout": idle_timeout}
    with progress.step("ingest", batches.counters):
        if available_now:
            reason = drain(start(AVAILABLE_NOW), batches)
        elif batch_bytes and topics.cheap_to_read_again:
            waiting = lambda: topics.size(spark, [SOURCE_TOPIC])
            reason, flushes = drain_by_size_and_clock(lambda: start(AVAILABLE_NOW), waiting, batches, batch_bytes, flush_interval, **limits)
            log.info("flushes: %s", flushes)
        elif batch_bytes:
            # The next batch starts when there is enough for it and must not
            # wait for a clock of ours: the broker's source has one.
            sized = lambda size: start(AS_SOON_AS_POSSIBLE, record_bytes=size)
            reason = drain_by_measured_size(sized, batches, MAX_MESSAGE_BYTES, **limits)
        else:
            reason = drain(start(time_trigger(flush_interval)), batches, **limits)
    ingested = batches.summary()
    log.info("ingest stopped: %s %s", reason, ingested)

    started = time.monotonic()
    landed, run = read_landed(spark, f"{run_dir}/landed"), new_run_id()

    done: dict[str, dict] = {}

    def sort(key: str, by: SortKey) -> int:
        emitted = Observation()
        size = F.coalesce(F.sum(F.octet_length("raw")), F.lit(0))
        ordered = global_sort(landed, by).observe(emitted, F.count(F.lit(1)).alias("records"), size.alias("payload_bytes"))
        topics.write_ordered(ordered, key, run)
        done[key] = emitted.get
        log.info("sorted %s: %s", key, emitted.get)
        return emitted.get["records"]

    def sorted_so_far() -> dict:
        return {name: sum(d[name] for d in list(done.values())) for name in ("records", "payload_bytes")}

    with scratch_removed(spark), progress.step("sort", sorted_so_far):
        emitted = dict.fromkeys(keys, 0) if landed.isEmpty() else for_each_key(spark, keys, sort)
    topics.complete(spark, run, emitted)
    progress.save()
    return {
        "run": run,
        "run_dir": run_dir,
        "stopped": reason,
        "ingest": ingested,
        "emitted": emitted,
        "sort_seconds": time.monotonic() - started,
    }


@dataclass
class Verdict:
    counts: DataFrame
    order: DataFrame
    report: DataFrame


def verify(spark: SparkSession, outputs: Mapping[str, str], expected: int) -> Verdict:
    """Counts against an expectation, sort order and samples of sorted outputs.

    Each output is read once, into a small table of its file splits that
    answers the first two. Samples are read by the outputs' manifests, or from
    the few files they are in.
    """
    scratch = new_run_dir(spark, "splits")

    def summarise(name: str, _) -> DataFrame:
        write_table(split_summaries(spark, outputs[name], name), f"{scratch}/{name}")
        return spark.read.parquet(f"{scratch}/{name}")

    splits = for_each_key(spark, dict.fromkeys(outputs, ()), summarise)
    order = order_of_outputs(splits)
    per_file = union_all(
        rows.groupBy("file_path").agg(F.sum("rows").alias("rows")).select(F.lit(name).alias("output"), "file_path", "rows")
        for name, rows in splits.items()
    )
    return Verdict(
        counts=count_check(order.select("output", "lines"), expected),
        order=order,
        report=sample_report(spark, outputs, per_file),
    )


def _drain_topics(
    spark: SparkSession, topics: Topics, names: list[str], run_dir: str, idle_timeout: float, available_now: bool, run: str | None
) -> DataFrame:
    """Land the topics' messages until nothing has come for a while."""
    batches = BatchLog()
    query = start_fanout(
        topics.stream(spark, names, run=run),
        f"{run_dir}/messages",
        f"{run_dir}/messages_checkpoint",
        batches,
        names,
        trigger=AVAILABLE_NOW if available_now else time_trigger(idle_timeout / 2),
    )
    limits = {} if available_now else {"idle_timeout": idle_timeout, "arm_after_first": True}
    drain(query, batches, **limits)
    log.info("topics drained: %s", batches.summary())
    return read_fanout(spark, f"{run_dir}/messages")


def validate(
    spark: SparkSession,
    topics: Topics,
    out_dir: str,
    run_dir: str | None = None,
    idle_timeout: float = OUTPUT_IDLE,
    available_now: bool = False,
    keys: Mapping[str, SortKey] = SORT_KEYS,
    report_path: str | None = None,
    run: str | None = None,
) -> dict[str, int]:
    """Drain the sorted topics of one run into one text output each and write the report.

    Without ``run`` it is the last complete one, or, if none is noted as
    complete, what the topics hold outside of runs. Records that came twice
    are written once. If a complete run has another number of records than it
    was noted with, the outputs are not whole and an error says so. Given the
    ``run_dir`` of an earlier call, the drain carries on where that stopped.
    """
    with scratch_removed(spark):
        written = _write_outputs(spark, topics, out_dir, list(keys), run, run_dir, idle_timeout, available_now)
    outputs = output_paths(out_dir, list(keys))
    write_report(report_lines(sample_report(spark, outputs), outputs), report_path or f"{out_dir}/results/SUCCESS.txt")
    log.info("report written")
    return written


def _write_outputs(
    spark: SparkSession, topics: Topics, out_dir: str, names: list[str], run: str | None, run_dir: str | None, idle_timeout: float, available_now: bool
) -> dict[str, int]:
    """The outputs of ``validate``; what was landed for them alone is not needed afterwards."""
    noted = topics.complete_runs(spark)
    run = run or latest_run(noted)
    if available_now and topics.cheap_to_read_again and run is not None:
        written = copy_topic_outputs(spark, lambda name: topics.read(spark, [name], run), out_dir, names)
    else:
        messages = _drain_topics(spark, topics, names, run_dir or new_run_dir(spark, "run"), idle_timeout, available_now, run)
        if run is None:
            # It may have been completed while its records came in.
            noted = topics.complete_runs(spark)
            run = latest_run(noted)
        messages = messages.where(F.col("run").eqNullSafe(F.lit(run)))
        written = write_topic_outputs(messages, out_dir, names)
    log.info("written %s of run %s", written, run)
    promised = {name: n for name, n in noted.get(run, {}).items() if name in written}
    if any(written[name] != n for name, n in promised.items()):
        raise RuntimeError(f"run {run} is not whole: {written} of {promised} records have come")
    return written
