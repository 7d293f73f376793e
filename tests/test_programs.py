from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyline.__main__ import duration, main, parser
from tallyline.operators.generate import generate_records
from tallyline.operators.sorting import global_sort
from tallyline.plans import run
from tallyline.sinks.text import output_paths
from tallyline.sources.topics import ARCHIVE_SCHEMA, ArchivedTopics, FileTopics, KafkaTopics, kafka_sink_options, kafka_source_options, latest_run, message_columns, new_run_id, ordered_rows
from tallyline.streaming.ingest import batch_stats, read_landed


def test_generate_process_validate(spark, tmp_path):
    topics = f"{tmp_path}/topics"
    made = main(["generate", "-topics", topics, "-max", "5000", "-workers", "3", "-seed", "9"])
    assert made["produced"] == 5000
    sorted_ = main(["process", "--topics", topics, "--available-now", "-batch", "8000"])
    assert sorted_["emitted"] == {"id": 5000, "name": 5000, "continent": 5000}
    assert sorted_["ingest"]["batches"] == 3
    done = main(
        ["validate", "-topics", topics, "-out", f"{tmp_path}/csv", "-report", f"{tmp_path}/results/SUCCESS.txt", "-available-now"]
    )
    outputs = output_paths(done["out_dir"])
    verdict = run.verify(spark, outputs, 5000)
    assert all(r.ok for r in verdict.counts.collect())
    assert {tuple(r)[1:] for r in verdict.order.collect()} == {(5000, 0, None)}
    assert verdict.report.count() == 30
    source = generate_records(spark, 5000, 9)
    for path in outputs.values():
        lines = spark.read.text(path, lineSep="\n")
        assert lines.exceptAll(source).isEmpty() and source.exceptAll(lines).isEmpty()
    report = [r.value for r in spark.read.text(f"{tmp_path}/results/SUCCESS.txt").collect()]
    assert len(report) == 3 * 14 and f"total lines path={outputs['id']} total_lines=5000" in report


def test_process_stops_at_the_expected_count_and_carries_on(spark, tmp_path):
    topics = FileTopics(f"{tmp_path}/topics")
    run.generate(spark, topics, 1000, 1, 2)
    options = dict(run_dir=f"{tmp_path}/run", idle_timeout=20, flush_interval=0.5)
    first = run.process(spark, topics, expected=1000, **options)
    assert first["stopped"] == "count" and first["emitted"]["id"] == 1000
    run.generate(spark, topics, 500, 2, 2)
    again = run.process(spark, FileTopics(topics.root), expected=500, **options)
    assert again["ingest"]["records"] == 500 and again["emitted"]["name"] == 1500
    assert latest_run(topics.complete_runs(spark)) == again["run"] > first["run"]
    # The second run's copies stand alone: each record once, in order.
    written = run.validate(spark, topics, f"{tmp_path}/out", available_now=True)
    assert written == {"id": 1500, "name": 1500, "continent": 1500}
    verdict = run.verify(spark, output_paths(f"{tmp_path}/out"), 1500)
    assert {tuple(r)[1:] for r in verdict.order.collect()} == {(1500, 0, None)}
    # The first run can still be read, and no position of the source topic is taken twice.
    assert run.validate(spark, topics, f"{tmp_path}/old", available_now=True, run=first["run"])["id"] == 1000
    source = topics.read(spark, ["source"])
    assert source.select("partition", "offset").distinct().count() == source.count() == 1500


def test_verify_command(spark, tmp_path):
    topics = FileTopics(f"{tmp_path}/topics")
    run.generate(spark, topics, 400, 1, 2)
    run.process(spark, topics, available_now=True)
    run.validate(spark, topics, f"{tmp_path}/out", available_now=True)
    result = main(["verify", "-out", f"{tmp_path}/out", "-max", "400"])
    assert [r["ok"] for r in result["counts"]] == [True] * 3
    assert [r["violations"] for r in result["order"]] == [0] * 3


def test_kafka_rows_carry_run_and_order(spark):
    ordered = generate_records(spark, 100, 1).repartition(10)
    rows = ordered_rows(ordered, "7", 3).collect()
    assert {r["partition"] for r in rows} == {0, 1, 2}
    seqs = [int(h["value"]) for r in rows for h in r["headers"] if h["key"] == "seq"]
    assert len(set(seqs)) == 100
    assert {bytes(h["value"]) for r in rows for h in r["headers"] if h["key"] == "run"} == {b"7"}


def _sorted_run(spark, topics, records, tasks, times, complete=True, keys=("id", "name")):
    """A run whose sort had ``tasks`` tasks, some of which ran twice."""
    run_id = new_run_id()
    for key in keys:
        rows = ordered_rows(global_sort(records, [key], tasks), run_id, topics.topic_partitions)
        # Landed, so that what is sent twice is the same.
        sent = f"{topics.root}-sent/{key}-{run_id}"
        rows.withColumn("task", F.spark_partition_id()).write.parquet(sent)
        sent = spark.read.parquet(sent)
        for n in range(times):
            # The first time all tasks send; then every third sends half of its records again.
            some = sent.where(f"task % 3 = {n}").sample(0.5, 3) if n else sent
            topics._save(some.drop("task").repartition(3), {"topic": key})
    if complete:
        topics.complete(spark, run_id, {key: records.count() for key in keys})
    return run_id


@pytest.mark.parametrize("available_now", [True, False])
def test_kafka_rows_of_the_last_complete_run(spark, tmp_path, available_now):
    """Eight sort tasks on two topic partitions, records sent twice, an older run and one that was not finished."""
    topics = ArchivedTopics(topic_partitions=2, root=f"{tmp_path}/kafka")
    keys = {"id": ("id",), "name": ("name",)}
    old, new, broken = (generate_records(spark, n, seed, 2) for n, seed in ((300, 1), (800, 2), (500, 3)))
    first = _sorted_run(spark, topics, old, 8, 2)
    last = _sorted_run(spark, topics, new, 8, 3)
    _sorted_run(spark, topics, broken, 8, 1, complete=False)
    assert topics.complete_runs(spark) == {first: {"id": 300, "name": 300}, last: {"id": 800, "name": 800}}
    assert topics.read(spark, ["id"], last).count() > 800
    options = dict(keys=keys, available_now=available_now, idle_timeout=3)
    assert run.validate(spark, topics, f"{tmp_path}/out", **options) == {"id": 800, "name": 800}
    verdict = run.verify(spark, output_paths(f"{tmp_path}/out", ["id", "name"]), 800)
    assert {tuple(r)[1:] for r in verdict.order.collect()} == {(800, 0, None)}
    lines = spark.read.text(output_paths(f"{tmp_path}/out")["name"], lineSep="\n")
    assert lines.exceptAll(new).isEmpty() and new.exceptAll(lines).isEmpty()
    if available_now:
        assert run.validate(spark, topics, f"{tmp_path}/old", run=first, **options) == {"id": 300, "name": 300}


def test_a_run_that_lost_records_is_an_error(spark, tmp_path):
    topics = ArchivedTopics(topic_partitions=2, root=f"{tmp_path}/kafka")
    records = generate_records(spark, 50, 1, 2)
    last = _sorted_run(spark, topics, records, 2, 1, complete=False)
    topics.complete(spark, last, {"id": 51, "name": 50})
    with pytest.raises(RuntimeError, match="not whole"):
        run.validate(spark, topics, f"{tmp_path}/out", keys={"id": ("id",), "name": ("name",)}, available_now=True)


def test_a_run_completed_while_its_records_come_in(spark, tmp_path, monkeypatch):
    """Records of several runs are landed, and the one noted in the end is taken."""
    topics = ArchivedTopics(topic_partitions=2, root=f"{tmp_path}/kafka")
    _sorted_run(spark, topics, generate_records(spark, 70, 1, 2), 3, 1, complete=False)
    last = _sorted_run(spark, topics, generate_records(spark, 90, 2, 2), 3, 2, complete=False)
    drained = run._drain_topics

    def then_complete(*args):
        rows = drained(*args)
        topics.complete(spark, last, {"id": 90, "name": 90})
        return rows

    monkeypatch.setattr(run, "_drain_topics", then_complete)
    assert run.validate(spark, topics, f"{tmp_path}/out", keys={"id": ("id",), "name": ("name",)}, available_now=True) == {"id": 90, "name": 90}


def test_generate_process_validate_on_kafka_rows(spark, tmp_path):
    topics = ArchivedTopics(topic_partitions=3, root=f"{tmp_path}/kafka")
    run.generate(spark, topics, 700, 5, 2)
    sorted_ = run.process(spark, topics, available_now=True)
    assert topics.complete_runs(spark) == {sorted_["run"]: sorted_["emitted"]}
    assert run.validate(spark, topics, f"{tmp_path}/out", available_now=True) == {"id": 700, "name": 700, "continent": 700}
    verdict = run.verify(spark, output_paths(f"{tmp_path}/out"), 700)
    assert {tuple(r)[1:] for r in verdict.order.collect()} == {(700, 0, None)}


class LimitedTopics(ArchivedTopics):
    """Kafka rows, one to a file, of which a batch takes as many as the connector would."""

    def _load(self, spark, options, stream=False):
        if not stream:
            return super()._load(spark, options)
        reader = spark.readStream.schema(ARCHIVE_SCHEMA).option("maxFilesPerTrigger", options["maxOffsetsPerTrigger"])
        return reader.parquet(f"{self.root}/{options['subscribe']}")


def test_batches_of_long_records_have_the_bytes_asked_for(spark, tmp_path):
    topics = LimitedTopics(topic_partitions=2, root=f"{tmp_path}/kafka")
    long = spark.range(40).select(F.concat(F.col("id").cast("string"), F.lit(",n,"), F.repeat(F.lit("x"), 5000), F.lit(",Asia")).alias("raw"))
    topics.write(long.repartition(40, "raw").where("raw is not null"), "source")
    files = spark.read.schema(ARCHIVE_SCHEMA).parquet(f"{tmp_path}/kafka/source").select("*", F.spark_partition_id().alias("p"))
    assert files.count() == 40
    done = run.process(spark, topics, run_dir=f"{tmp_path}/run", idle_timeout=4, flush_interval=1, expected=40, batch_bytes=60_000, keys={"id": ("id",)})
    assert done["ingest"]["records"] == 40 and done["emitted"] == {"id": 40}
    landed = batch_stats(read_landed(spark, f"{tmp_path}/run/landed")).orderBy("batch_id").collect()
    # Fixed sizes would have put a thousand records into the first batch.
    assert max(r["payload_bytes"] for r in landed) <= 2 * 60_000 and len(landed) >= 3


def test_records_without_a_run_keep_their_place(spark, tmp_path):
    topics = ArchivedTopics(topic_partitions=2, root=f"{tmp_path}/kafka")
    topics.write(generate_records(spark, 40, 1, 2), "id")
    assert topics.complete_runs(spark) == {}
    rows = message_columns(topics._load(spark, {"subscribe": "id"}))
    assert rows.where("run is null").select("partition", "offset").distinct().count() == 40
    assert run.validate(spark, topics, f"{tmp_path}/out", keys={"id": ("id",)}, available_now=True) == {"id": 40}


def test_validate_waits_for_messages_until_idle(spark, tmp_path):
    topics = FileTopics(f"{tmp_path}/topics")
    run.generate(spark, topics, 300, 1, 2)
    run.process(spark, topics, run_dir=f"{tmp_path}/run", available_now=True)
    written = run.validate(spark, topics, f"{tmp_path}/out", run_dir=f"{tmp_path}/run", idle_timeout=2)
    assert written == {"id": 300, "name": 300, "continent": 300}
    verdict = run.verify(spark, output_paths(f"{tmp_path}/out"), 300)
    assert {tuple(r)[1:] for r in verdict.order.collect()} == {(300, 0, None)}


def test_nothing_to_sort(spark, tmp_path):
    topics = FileTopics(f"{tmp_path}/topics")
    run.generate(spark, topics, 0, 1, 2)
    result = run.process(spark, topics, run_dir=f"{tmp_path}/run", available_now=True)
    assert result["emitted"] == {"id": 0, "name": 0, "continent": 0}


def test_flush_longer_than_timeout_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        run.process(spark, FileTopics(str(tmp_path)), idle_timeout=5, flush_interval=10)


def test_flags_and_defaults():
    args = parser().parse_args(["process"])
    assert (args.max, args.batch, args.timeout, args.flush) == (50_000_000, 100_000_000, 40, 10)
    args = parser().parse_args(["generate", "-max", "7", "-workers", "2", "-debug"])
    assert (args.max, args.workers, args.debug) == (7, 2, True)
    assert [duration(t) for t in ("40s", "1m30s", "500ms", "2")] == [40, 90, 0.5, 2]


def test_kafka_options(monkeypatch):
    monkeypatch.delenv("KAFKA_BROKER", raising=False)
    source = kafka_source_options(["id", "name"], batch_bytes=100_000_000, flush_interval=10)
    assert source["kafka.bootstrap.servers"] == "localhost:9092"
    assert source["subscribe"] == "id,name" and source["startingOffsets"] == "earliest"
    assert source["maxOffsetsPerTrigger"] == source["minOffsetsPerTrigger"] == "2000000"
    assert source["maxTriggerDelay"] == "10000ms"
    assert "maxOffsetsPerTrigger" not in kafka_source_options(["id"])
    monkeypatch.setenv("KAFKA_BROKER", "broker:1")
    sink = kafka_sink_options("id")
    assert (sink["kafka.bootstrap.servers"], sink["topic"], sink["kafka.compression.type"]) == ("broker:1", "id", "lz4")
    assert KafkaTopics(topic_partitions=12).topic_partitions == 12
