"""Every operator as a query over the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.records import encode_record, key_from_path, normalise_lines, parse_records, payload_bytes
from tallyline.operators import checks, sampling, sorting
from tallyline.operators.generate import records_for, spread
from tallyline.operators.positions import number_lines, with_line_numbers
from tallyline.plans import feeds
from tallyline.plans import run as programs
from tallyline.session import MAX_SORT_PARTITIONS_KEY, folders_unsorted, new_run_dir
from tallyline.sinks.ordered import write_lines
from tallyline.sinks.text import copy_topic_outputs, output_paths, route_by_topic, write_report, write_sorted_outputs
from tallyline.sources.lines import read_lines, scan_records
from tallyline.sources.ordered import read_numbered
from tallyline.sources.topics import SOURCE_TOPIC, ArchivedTopics, FileTopics
from tallyline.streaming.drain import drain, drain_by_size_and_clock, time_trigger
from tallyline.streaming.ingest import (
    AVAILABLE_NOW,
    BatchLog,
    batch_stats,
    read_fanout,
    read_landed,
    start_fanout,
    start_ingest,
)
from tallyline.streaming.progress import read_progress

Query = Callable[[SparkSession, str], DataFrame]

KEYS = list(sorting.SORT_KEYS)


def _numbered_sort(df: DataFrame, by: sorting.SortKey) -> DataFrame:
    table = sorting.sorted_table(df, by, new_run_dir(df.sparkSession, "sorted"))
    return with_line_numbers(table)


def sort_by_id(spark, sf):
    return _numbered_sort(feeds.lineitems(spark, sf), ["id"])


def sort_by_name(spark, sf):
    return _numbered_sort(feeds.customers(spark, sf), ["name"])


def sort_by_continent(spark, sf):
    return _numbered_sort(feeds.orders(spark, sf), ["continent"])


def sort_hot_key(spark, sf):
    """Six distinct keys: most rows share theirs with a sixth of the table."""
    return _numbered_sort(feeds.lineitems(spark, sf), ["name"])


def sort_hot_record(spark, sf):
    """A handful of distinct records, each repeated for a large part of the table."""
    line = feeds.table(spark, sf, "lineitem")
    same = F.concat_ws(",", F.lit("0"), F.col("l_returnflag"), F.lit(""), F.col("l_linestatus"))
    return _numbered_sort(line.select(same.alias("raw")), ["id"])


def sort_malformed(spark, sf):
    return _numbered_sort(normalise_lines(feeds.documents(spark, sf)), ["id"])


def sort_custom_key(spark, sf):
    return _numbered_sort(feeds.customers(spark, sf), [F.col("address").desc(), "id"])


def sort_in_two_steps(spark, sf):
    """A sort that may make few partitions in one shuffle: coarse ranges first, each stretch of them by itself."""
    small = spark.newSession()
    small.conf.set(MAX_SORT_PARTITIONS_KEY, "3")
    path = new_run_dir(small, "sorted")
    table = sorting.sorted_table(feeds.lineitems(small, sf), ["name"], path)
    # Read in the caller's session, whose settings stay as they are.
    return with_line_numbers(spark.read.schema("raw string").parquet(*(unquote(f) for f in table.inputFiles())))


def sort_fanout(spark, sf):
    return sorting.sort_fanout(feeds.orders(spark, sf), new_run_dir(spark, "fanout"))


def merge_runs(spark, sf):
    """One run file folder per topic, in no common order, merged by id."""
    run = new_run_dir(spark, "runs")
    events = feeds.messages(spark, sf)
    with folders_unsorted(spark):
        events.select("topic", "value").write.partitionBy("topic").text(run, lineSep="\n")
    folders = [f"{run}/topic={topic}" for topic in feeds.EVENT_TOPICS.values()]
    target = new_run_dir(spark, "merged")
    sorting.merge_runs(spark, folders, ["id"]).write.parquet(target)
    return with_line_numbers(spark.read.schema("raw string").parquet(target))


def line_numbers(spark, sf):
    path = new_run_dir(spark, "lines")
    write_lines(sorting.global_sort(feeds.orders(spark, sf), ["name"]), path)
    return read_numbered(spark, {"name": path}).select("line_no", F.col("line").alias("raw"))


def line_numbers_by_counting(spark, sf):
    """The same where no manifest was written: files of another writer, counted first."""
    path = new_run_dir(spark, "lines")
    sorting.global_sort(feeds.orders(spark, sf), ["name"]).write.text(path, lineSep="\n")
    return number_lines(read_lines(spark, path)).select("line_no", F.col("line").alias("raw"))


def parse(spark, sf):
    return parse_records(feeds.customers(spark, sf))


def parse_malformed(spark, sf):
    return parse_records(normalise_lines(feeds.documents(spark, sf)))


def parse_lenient_id(spark, sf):
    return parse_records(feeds.documents(spark, sf).withColumnRenamed("value", "raw"), "id").select("doc_id", "id")


def encode(spark, sf):
    parsed = parse_records(feeds.lineitems(spark, sf))
    return parsed.select(encode_record(*[F.col(c) for c in ("id", "name", "address", "continent")]).alias("raw"))


def payload(spark, sf):
    return feeds.documents(spark, sf).select("doc_id", payload_bytes(F.col("value")).alias("payload_bytes"))


def lines_of_documents(spark, sf):
    return normalise_lines(feeds.documents(spark, sf))


def keys_from_paths(spark, sf):
    docs = feeds.table(spark, sf, "documents")
    lang, source = F.col("lang"), F.col("source")
    paths = F.array(F.concat(lang, F.lit("_"), source), source, F.concat(lang, F.lit("_")))
    return docs.select("doc_id", F.explode(paths).alias("path")).withColumn("key", key_from_path(F.col("path")))


def filter_topic(spark, sf):
    return feeds.messages(spark, sf).where(F.col("topic") == "source").select("offset", "value")


def _as_topics(messages: DataFrame) -> FileTopics:
    """The messages as file topics, one folder each."""
    topics = FileTopics(new_run_dir(messages.sparkSession, "topics"))
    for topic in feeds.EVENT_TOPICS.values():
        messages.where(F.col("topic") == topic).write.parquet(topics.path(topic))
    return topics


def _all_topics(messages: DataFrame) -> FileTopics:
    """The messages in one folder that is read as topic 'source', foreign topics among them."""
    topics = FileTopics(new_run_dir(messages.sparkSession, "topics"))
    messages.write.mode("append").parquet(topics.path("source"))
    return topics


def _ingest(spark, topics: FileTopics, run: str, batch_bytes: int | None = None, trigger=AVAILABLE_NOW, **limits) -> BatchLog:
    log = BatchLog()
    stream = topics.stream(spark, ["source"], batch_bytes)
    drain(start_ingest(stream, f"{run}/landed", f"{run}/checkpoint", log, trigger=trigger), log, **limits)
    return log


def stream_source(spark, sf):
    run = new_run_dir(spark, "ingest")
    _ingest(spark, _all_topics(feeds.messages(spark, sf)), run)
    return read_landed(spark, f"{run}/landed").select("raw")


def size_cut_batches(spark, sf):
    """Batches of about half a megabyte, however many that takes."""
    run = new_run_dir(spark, "ingest")
    topics = FileTopics(new_run_dir(spark, "topics"))
    topics.write(feeds.orders(spark, sf).repartition(8), "source")
    _ingest(spark, topics, run, batch_bytes=512 * 1024)
    return read_landed(spark, f"{run}/landed").select("raw")


def drain_until_count(spark, sf):
    run, topics = new_run_dir(spark, "ingest"), FileTopics(new_run_dir(spark, "topics"))
    records = feeds.orders(spark, sf)
    topics.write(records, "source")
    _ingest(spark, topics, run, trigger=time_trigger(0.5), until_count=records.count())
    return read_landed(spark, f"{run}/landed").select("raw")


def drain_until_idle(spark, sf):
    """Both clocks: one armed from the start, one by the first message."""
    run, topics = new_run_dir(spark, "ingest"), FileTopics(new_run_dir(spark, "topics"))
    topics.write(feeds.orders(spark, sf), "source")
    _ingest(spark, topics, run, trigger=time_trigger(0.5), idle_timeout=2, arm_after_first=True)
    topics.write(feeds.customers(spark, sf), "source")
    _ingest(spark, topics, run, trigger=time_trigger(0.5), idle_timeout=5)
    return read_landed(spark, f"{run}/landed").select("raw")


def flush_by_size_and_clock(spark, sf):
    """Orders fill batches; customers do not, and wait for the clock. What caused the flushes comes with the records."""
    run, topics = new_run_dir(spark, "ingest"), FileTopics(new_run_dir(spark, "topics"))
    topics.write(feeds.orders(spark, sf).repartition(4), SOURCE_TOPIC)
    size, log = topics.size(spark, [SOURCE_TOPIC]), BatchLog()
    waits = [feeds.customers(spark, sf)]

    def start():
        return start_ingest(topics.stream(spark, [SOURCE_TOPIC], size // 2), f"{run}/landed", f"{run}/checkpoint", log)

    def waiting() -> int:
        # The customers come once the orders have been taken.
        if log.records and waits:
            topics.write(waits.pop().coalesce(1), SOURCE_TOPIC)
        return topics.size(spark, [SOURCE_TOPIC])

    _, flushes = drain_by_size_and_clock(start, waiting, log, size // 2, 1.5, idle_timeout=4)
    causes = F.lit(",".join(dict.fromkeys(flushes)))
    return read_landed(spark, f"{run}/landed").select("raw", causes.alias("flushes"))


def run_progress(spark, sf):
    """The last progress row of each step of a run."""
    run, topics = new_run_dir(spark, "run"), FileTopics(new_run_dir(spark, "topics"))
    topics.write(feeds.orders(spark, sf).repartition(4), SOURCE_TOPIC)
    programs.process(spark, topics, run_dir=run, available_now=True, batch_bytes=256 * 1024, progress_interval=0.2)
    rows = read_progress(spark, f"{run}/progress")
    last = rows.groupBy("step").agg(F.max_by(F.struct("records", "payload_bytes", "dropped", "ended"), "seq").alias("r"))
    return last.select("step", "r.*")


def run_counters(spark, sf):
    """Counted while the batches are written; one row whatever the volume."""
    log = _ingest(spark, _all_topics(feeds.messages(spark, sf)), new_run_dir(spark, "ingest"))
    total = {name: sum(batch[name] for batch in log.batches) for name in ("records", "payload_bytes", "rejected")}
    return spark.createDataFrame([tuple(total.values())], "records long, payload_bytes long, rejected long")


def resume_with_late_data(spark, sf):
    """A second run on the same checkpoint takes only what arrived in between."""
    run, messages = new_run_dir(spark, "ingest"), feeds.messages(spark, sf)
    as_source = messages.withColumn("topic", F.lit("source"))
    topics = _all_topics(as_source.where(messages["topic"] != "audit"))
    _ingest(spark, topics, run)
    as_source.where(messages["topic"] == "audit").write.mode("append").parquet(topics.path("source"))
    _ingest(spark, topics, run)
    return read_landed(spark, f"{run}/landed").select("raw")


def multi_topic_source(spark, sf):
    return _as_topics(feeds.messages(spark, sf)).read(spark, KEYS).select("topic", "offset", "value")


def stream_fanout(spark, sf):
    run, topics = new_run_dir(spark, "fanout"), _as_topics(feeds.messages(spark, sf))
    log = BatchLog()
    drain(start_fanout(topics.stream(spark, KEYS), f"{run}/messages", f"{run}/checkpoint", log, KEYS), log)
    return read_fanout(spark, f"{run}/messages").select("topic", "offset", "value")


def scan_lines(spark, sf):
    path = new_run_dir(spark, "lines")
    feeds.lineitems(spark, sf).write.text(path, lineSep="\n")
    return scan_records(spark, path)


def topic_sink(spark, sf):
    topics = FileTopics(new_run_dir(spark, "topics"))
    topics.write(feeds.orders(spark, sf), "source")
    return topics.read(spark, ["source"]).select("value")


def ordered_topic_sink(spark, sf):
    """Sorted into a topic, then from the topic into a file in topic order."""
    run = new_run_dir(spark, "topics")
    topics = FileTopics(run)
    topics.write_ordered(sorting.global_sort(feeds.orders(spark, sf), ["continent"]), "continent", "1")
    copy_topic_outputs(spark, lambda topic: topics.read(spark, [topic], "1"), f"{run}/out", ["continent"])
    return read_numbered(spark, output_paths(f"{run}/out", ["continent"])).select("line_no", F.col("line").alias("raw"))


def kafka_rows_roundtrip(spark, sf):
    """Kafka rows of two runs, some sent twice, and of one that was not finished: the outputs of the last complete run."""
    root = new_run_dir(spark, "kafka")
    topics = ArchivedTopics(topic_partitions=2, root=f"{root}/topics")
    for records in (feeds.customers(spark, sf), feeds.orders(spark, sf)):
        topics.write(records, SOURCE_TOPIC)
        run = programs.process(spark, topics, run_dir=f"{root}/run", available_now=True)["run"]
    for key in KEYS:
        rows = topics._load(spark, {"subscribe": key})
        ours = F.exists("headers", lambda h: h["value"] == F.encode(F.lit(run), "UTF-8"))
        # A task that ran twice has sent its records twice.
        topics._save(rows.where(ours & (F.col("offset") % 3 == 0)).select("partition", "value", "headers"), {"topic": key})
        topics.write_ordered(sorting.global_sort(feeds.customers(spark, sf), [key]), key, f"{int(run) + 1:020d}")
    programs.validate(spark, topics, f"{root}/out", available_now=True)
    return read_numbered(spark, output_paths(f"{root}/out")).select("output", "line_no", F.col("line").alias("raw"))


def _orders_outputs(spark, sf) -> dict[str, str]:
    root = new_run_dir(spark, "outputs")
    write_sorted_outputs(feeds.orders(spark, sf), root)
    return output_paths(root)


def sorted_files_roundtrip(spark, sf):
    root = new_run_dir(spark, "outputs")
    write_sorted_outputs(feeds.customers(spark, sf), root)
    return read_numbered(spark, output_paths(root)).select("output", "line_no", F.col("line").alias("raw"))


def routed(spark, sf):
    path = new_run_dir(spark, "routed")
    route_by_topic(feeds.messages(spark, sf), path, KEYS)
    return spark.read.schema("value string, topic string").text(path, lineSep="\n").select("topic", "value")


def routed_counts(spark, sf):
    counts = route_by_topic(feeds.messages(spark, sf), new_run_dir(spark, "routed"), KEYS)
    return spark.createDataFrame([(counts["routed"], counts["rejected"])], "routed long, rejected long")


def batches(spark, sf):
    lines = feeds.lineitems(spark, sf, F.col("l_linenumber").cast("bigint").alias("batch_id"))
    return batch_stats(lines)


def emitted_counts(spark, sf):
    emitted = write_sorted_outputs(feeds.orders(spark, sf), new_run_dir(spark, "outputs"))
    return spark.createDataFrame(list(emitted.items()), "sort_key string, emitted long")


def sample_head(spark, sf):
    rows = sampling.head(feeds.lineitems(spark, sf), ["continent"])
    # Three rows, in order in one partition.
    return rows.select((F.monotonically_increasing_id() + 1).alias("line_no"), "raw")


def sample_mid(spark, sf):
    path = new_run_dir(spark, "sorted")
    sorting.global_sort(feeds.lineitems(spark, sf), ["continent"]).write.parquet(path)
    sections = sampling.sample_tables(spark, {"continent": path})
    return sections.where(F.col("section") == "mid").select("line_no", F.col("line").alias("raw"))


def sample_tail(spark, sf):
    return sampling.tail(feeds.lineitems(spark, sf), ["continent"])


def key_extremes(spark, sf):
    return sampling.key_extremes(feeds.lineitems(spark, sf), {key: key for key in KEYS})


def sample_report(spark, sf):
    return sampling.sample_report(spark, _orders_outputs(spark, sf))


def sample_tables(spark, sf):
    root, records = new_run_dir(spark, "sorted"), feeds.lineitems(spark, sf)
    paths = {key: f"{root}/sorted_{key}" for key in KEYS}
    sorting.for_each_key(spark, sorting.SORT_KEYS, lambda key, by: sorting.sorted_table(records, by, paths[key]))
    return sampling.sample_tables(spark, paths)


def report_text(spark, sf):
    rows = sampling.sample_report(spark, _orders_outputs(spark, sf))
    return sampling.report_lines(rows, {key: key for key in KEYS})


def report_sink(spark, sf):
    """The report as read back from where it was written."""
    path = new_run_dir(spark, "report")
    write_report(report_text(spark, sf), path)
    return number_lines(read_lines(spark, path)).select("line_no", F.col("line").alias("text"))


def count_per_output(spark, sf):
    return checks.count_per_output(spark, _orders_outputs(spark, sf))


def count_check(spark, sf):
    """Held against the wrong expectation on purpose: orders are not as many as line items."""
    expected = feeds.table(spark, sf, "lineitem").count()
    return checks.count_check(checks.count_per_output(spark, _orders_outputs(spark, sf)), expected)


def order_check(spark, sf):
    root = new_run_dir(spark, "outputs")
    write_sorted_outputs(feeds.lineitems(spark, sf), root)
    return checks.order_check(spark, output_paths(root))


def order_check_unsorted(spark, sf):
    """An output in name order, checked by every field."""
    path = new_run_dir(spark, "outputs")
    write_lines(sorting.global_sort(feeds.orders(spark, sf), ["name"]), path)
    fields = ["id", "name", "address", "continent"]
    return checks.order_check(spark, {f"by_{f}": path for f in fields}, {f"by_{f}": f for f in fields})


def generate(spark, sf):
    """A record for every line item, from its order and line number."""
    rows = feeds.table(spark, sf, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row"))
    return records_for(spread(rows, "row"), "row", seed=3).select("raw")


def carry_on_roundtrip(spark, sf):
    """Customers in a first run, orders added in a second one that carries on; then the outputs of the last run."""
    root = new_run_dir(spark, "carry_on")
    topics = FileTopics(f"{root}/topics")
    for records in (feeds.customers(spark, sf), feeds.orders(spark, sf)):
        topics.write(records, SOURCE_TOPIC)
        programs.process(spark, topics, run_dir=f"{root}/run", available_now=True)
    programs.validate(spark, topics, f"{root}/out", available_now=True)
    return read_numbered(spark, output_paths(f"{root}/out")).select("output", "line_no", F.col("line").alias("raw"))


def ingested_batches(spark, sf):
    """Statistics of size-cut batches as they were ingested, held against their log and added up."""
    run, topics = new_run_dir(spark, "ingest"), FileTopics(new_run_dir(spark, "topics"))
    topics.write(feeds.lineitems(spark, sf).repartition(4), SOURCE_TOPIC)
    log = _ingest(spark, topics, run, batch_bytes=1)
    logged = spark.createDataFrame(
        [(b["batch_id"], b["records"], b["payload_bytes"]) for b in log.batches], "batch_id long, records long, payload_bytes long"
    )
    stats = batch_stats(read_landed(spark, f"{run}/landed"))
    # A batch log of several batches with the very same figures, and no other.
    same = logged.exceptAll(stats).isEmpty() and len(log.batches) > 1
    return stats.agg(F.lit(int(same)).alias("batches_ok"), F.sum("records").alias("records"), F.sum("payload_bytes").alias("payload_bytes"))


def generate_for_rows(spark, sf):
    return records_for(feeds.table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", seed=7)


QUERIES: dict[str, Query] = {
    "sort_by_name": sort_by_name,
    "sort_by_id": sort_by_id,
    "sort_by_continent": sort_by_continent,
    "sort_hot_key": sort_hot_key,
    "sort_hot_record": sort_hot_record,
    "sort_malformed": sort_malformed,
    "sort_custom_key": sort_custom_key,
    "sort_in_two_steps": sort_in_two_steps,
    "sort_fanout": sort_fanout,
    "merge_runs": merge_runs,
    "line_numbers": line_numbers,
    "line_numbers_by_counting": line_numbers_by_counting,
    "parse_records": parse,
    "parse_malformed": parse_malformed,
    "parse_lenient_id": parse_lenient_id,
    "encode_record": encode,
    "payload_bytes": payload,
    "normalise_lines": lines_of_documents,
    "key_from_path": keys_from_paths,
    "filter_topic": filter_topic,
    "stream_source": stream_source,
    "size_cut_batches": size_cut_batches,
    "drain_until_count": drain_until_count,
    "drain_until_idle": drain_until_idle,
    "multi_topic_source": multi_topic_source,
    "scan_lines": scan_lines,
    "topic_sink": topic_sink,
    "ordered_topic_sink": ordered_topic_sink,
    "sorted_files_roundtrip": sorted_files_roundtrip,
    "route_by_topic": routed,
    "routed_counts": routed_counts,
    "stream_fanout": stream_fanout,
    "resume_with_late_data": resume_with_late_data,
    "flush_by_size_and_clock": flush_by_size_and_clock,
    "run_progress": run_progress,
    "run_counters": run_counters,
    "batch_stats": batches,
    "ingested_batches": ingested_batches,
    "carry_on_roundtrip": carry_on_roundtrip,
    "kafka_rows_roundtrip": kafka_rows_roundtrip,
    "emitted_counts": emitted_counts,
    "sample_head": sample_head,
    "sample_mid": sample_mid,
    "sample_tail": sample_tail,
    "key_extremes": key_extremes,
    "sample_report": sample_report,
    "sample_tables": sample_tables,
    "report_text": report_text,
    "report_sink": report_sink,
    "count_per_output": count_per_output,
    "count_check": count_check,
    "order_check": order_check,
    "order_check_unsorted": order_check_unsorted,
    "generate_records": generate,
    "generate_for_rows": generate_for_rows,
}
