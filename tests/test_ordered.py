"""Ordered line files and their manifest: numbers, ranges, samples, order without a shuffle."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from tallyline.operators import sampling
from tallyline.operators.generate import generate_records
from tallyline.operators.positions import number_lines
from tallyline.operators.sorting import global_sort
from tallyline.plans import feeds
from tallyline.session import new_run_dir
from tallyline.sinks import ordered
from tallyline.sinks.text import copy_topic_outputs, output_paths
from tallyline.sources import ordered as reading
from tallyline.sources.lines import read_lines
from tallyline.sources.topics import FileTopics

from test_plans import exchanges, plan


@pytest.fixture
def small_steps(monkeypatch):
    """Many marks, steps that have to widen, and pieces shorter than lines."""
    monkeypatch.setattr(ordered, "STEP", 64)
    monkeypatch.setattr(ordered, "MAX_MARKS", 8)
    monkeypatch.setattr(reading, "READ_BYTES", 500)


def some_lines(n: int) -> list[str]:
    rng = random.Random(n)
    return [rng.choice(["", "é", "a,b", "x" * 3000, "\r", "日本語 " * 9, str(k)]) + f"|{k}" * rng.randrange(2) for k in range(n)]


@pytest.mark.parametrize("n, parts", [(0, 1), (1, 1), (1, 3), (400, 1), (400, 7)])
def test_lines_come_back_numbered(spark, tmp_path, small_steps, n, parts):
    lines = some_lines(n)
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "k int, raw string").repartitionByRange(parts, "k").sortWithinPartitions("k")
    path = f"{tmp_path}/out"
    assert ordered.write_lines(rows.select("raw"), path) == n
    got = reading.read_numbered(spark, {"x": path}).collect()
    assert sorted((r["output"], r["line_no"], r["line"]) for r in got) == [("x", k, x) for k, x in enumerate(lines, 1)]
    # Whoever knows nothing of manifests reads the same lines, in the same order of files.
    assert sorted(r["value"] for r in spark.read.text(path, lineSep="\n").collect()) == sorted(lines)
    counted = number_lines(read_lines(spark, path)).select("line_no", "line").collect()
    assert sorted(map(tuple, counted)) == sorted((r["line_no"], r["line"]) for r in got)
    assert os.path.exists(f"{path}/_SUCCESS")


def test_marks_are_line_starts(spark, tmp_path, small_steps):
    path = f"{tmp_path}/out"
    ordered.write_lines(spark.createDataFrame([(x,) for x in some_lines(900)], "raw string").coalesce(1), path)
    (r,) = spark.read.parquet(f"{path}/_manifest").collect()
    data = open(f"{path}/{r['file']}", "rb").read()
    assert (r["lines"], r["bytes"]) == (data.count(b"\n"), len(data)) and 4 <= len(r["marks"]) <= 8
    for mark in r["marks"]:
        assert data[: mark["byte"]].count(b"\n") == mark["line"]
        assert mark["byte"] == 0 or data[mark["byte"] - 1 : mark["byte"]] == b"\n"


def test_records_with_line_ends_null_and_invalid_bytes(spark, tmp_path):
    rows = spark.range(1).select(F.explode(F.array(F.lit("a\nb"), F.lit(None), F.lit(""), F.unhex(F.lit("FF41")).cast("string"))).alias("raw"))
    path = f"{tmp_path}/out"
    assert ordered.write_lines(rows.coalesce(1), path) == 5
    (name,) = [n for n in os.listdir(path) if n.startswith("part-")]
    assert open(f"{path}/{name}", "rb").read() == b"a\nb\n\n\n\xffA\n"
    got = reading.read_numbered(spark, {"x": path}).select("line_no", F.hex(F.col("line").cast("binary")).alias("h")).collect()
    assert sorted(map(tuple, got)) == [(1, "61"), (2, "62"), (3, ""), (4, ""), (5, "FF41")]


def test_lines_of_parts_in_any_task(spark, tmp_path):
    """Tasks that hold stretches of several parts, and parts that lie in several tasks."""
    placed = [(p, k, f"{p}-{k}") for p in (3, 100001, 0) for k in range(50)]
    rows = spark.createDataFrame(placed, "part long, place long, raw string").repartition(1).sortWithinPartitions(F.col("part").desc(), "place")
    path = f"{tmp_path}/out"
    assert ordered.write_lines(rows.union(spark.createDataFrame([(3, 50 + k, f"3-{50 + k}") for k in range(9)], rows.schema)), path) == 159
    got = [r["line"] for r in reading.read_numbered(spark, {"x": path}).orderBy("line_no").collect()]
    assert got == [f"0-{k}" for k in range(50)] + [f"3-{k}" for k in range(59)] + [f"100001-{k}" for k in range(50)]
    assert sorted(map(tuple, number_lines(read_lines(spark, path)).select("line_no", "line").collect())) == list(enumerate(got, 1))


def test_what_a_lost_attempt_wrote_is_no_output(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/out"
    made = ordered.write_table

    def with_leftover(rows, target):
        made(rows, target)
        with open(f"{path}/part-00000-000000000000-lost.txt", "w") as f:
            f.write("half a li")

    monkeypatch.setattr(ordered, "write_table", with_leftover)
    assert ordered.write_lines(generate_records(spark, 100, 1, 3), path) == 100
    assert read_lines(spark, path).count() == 100 == reading.read_numbered(spark, {"x": path}).count()


def test_samples_read_a_few_stretches(spark, sf_dir, tmp_path):
    paths = output_paths(f"{tmp_path}/out", ["id", "name"])
    for key, path in paths.items():
        ordered.write_lines(global_sort(feeds.lineitems(spark, sf_dir), [key], 4), path)
    sampled = sampling.sample_report(spark, paths)
    plain = sampling.sample_report(spark, {k: f"{p}" for k, p in paths.items()}, sampling.lines_per_file(spark, paths))
    assert sorted(map(tuple, sampled.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    ranges = reading.stretches(reading.manifest(spark, paths))
    total = reading.manifest(spark, paths).agg(F.sum("bytes")).first()[0]
    near = reading.read_lines_between(spark, paths, lambda t: [(t, t)])
    assert near.count() == 2
    widest = ranges.agg(F.max(F.col("high") - F.col("low"))).first()[0]
    assert widest <= 2 * ordered.STEP < total / 50


def test_samples_of_small_and_missing_outputs(spark, tmp_path, small_steps):
    sizes = {"none": 0, "one": 1, "four": 4, "many": 300}
    paths = {name: f"{tmp_path}/{name}" for name in sizes}
    for name, n in sizes.items():
        ordered.write_lines(spark.createDataFrame([(x,) for x in some_lines(n)], "raw string").coalesce(1), paths[name])
    got = sampling.sample_report(spark, paths).collect()
    for name, n in sizes.items():
        lines = some_lines(n)
        want = {("head", k) for k in range(1, 4)} | {("mid", k) for k in range(n // 2, n // 2 + 3)} | {("tail", k) for k in range(n - 2, n + 1)}
        want = {(s, k, lines[k - 1]) for s, k in want if 1 <= k <= n} | {("total", n, None)}
        assert {(r["section"], r["line_no"], r["line"]) for r in got if r["output"] == name} == want


def test_numbering_scans_once_and_moves_no_line(spark, tmp_path):
    path = f"{tmp_path}/out"
    ordered.write_lines(global_sort(generate_records(spark, 2000, 1, 3), ["id"], 5), path)
    p = plan(reading.read_numbered(spark, {"id": path}))
    # Lines come out of the range reader, and nothing is shuffled or joined above it.
    above, below = p.split("MapInArrow")
    assert exchanges(above) == [] and "Join" not in above
    assert "FileScan parquet" in below and "FileScan text" not in p


def test_topics_are_copied_without_a_shuffle(spark, tmp_path, monkeypatch):
    topics = FileTopics(f"{tmp_path}/topics")
    records = generate_records(spark, 3000, 1, 4)
    topics.write_ordered(global_sort(records, ["name"], 6), "name", "1")
    plans = []
    made = ordered.write_table

    def seen(rows, target):
        plans.append(plan(rows))
        made(rows, target)

    monkeypatch.setattr(ordered, "write_table", seen)
    assert copy_topic_outputs(spark, lambda t: topics.read(spark, [t], "1"), f"{tmp_path}/out", ["name"]) == {"name": 3000}
    assert exchanges(plans[0]) == [] and "Sort" not in plans[0]
    got = [r["line"] for r in reading.read_numbered(spark, output_paths(f"{tmp_path}/out", ["name"])).orderBy("line_no").collect()]
    assert got == sorted((r["raw"] for r in records.collect()), key=lambda x: (x.split(",")[1], x))


def test_outputs_in_split_files_keep_their_order(spark, tmp_path):
    """A topic whose files are read in several splits, in any order of tasks."""
    topics = FileTopics(new_run_dir(spark, "topics"))
    records = generate_records(spark, 20_000, 2, 2)
    topics.write_ordered(global_sort(records, ["id"], 3), "id", "1")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        copy_topic_outputs(spark, lambda t: topics.read(spark, [t], "1"), f"{tmp_path}/out", ["id"])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    got = [r["line"] for r in reading.read_numbered(spark, output_paths(f"{tmp_path}/out", ["id"])).orderBy("line_no").collect()]
    assert got == sorted((r["raw"] for r in records.collect()), key=lambda x: (int(x.split(",")[0]), x))
