from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from tallyline import session
from tallyline.functions.records import parse_records
from tallyline.operators.positions import number_lines, with_line_numbers
from tallyline.operators import sorting
from tallyline.operators.sorting import SORT_KEYS, global_sort, merge_runs, sort_fanout, sorted_table
from tallyline.operators.generate import generate_records
from tallyline.plans import feeds
from tallyline.session import scan_bytes, new_run_dir, repeatable, sort_partitions
from tallyline.sinks.ordered import write_lines
from tallyline.sinks.text import output_paths, write_sorted_outputs
from tallyline.sources.lines import read_lines, scan_records
from tallyline.sources.ordered import read_numbered


def in_order(df) -> list[str]:
    return [r.raw for r in df.collect()]


def test_bytewise_order_and_wrapped_ids(spark):
    df = spark.createDataFrame([(r,) for r in ["1,a,x,Asia", "2,Z,x,Asia", "2147483648,é,x,Asia", "9,b", ""]], "raw string")
    assert in_order(global_sort(df, ["name"], 3)) == ["", "9,b", "2,Z,x,Asia", "1,a,x,Asia", "2147483648,é,x,Asia"]
    assert in_order(global_sort(df, ["id"], 3)) == ["2147483648,é,x,Asia", "", "1,a,x,Asia", "2,Z,x,Asia", "9,b"]


@pytest.mark.parametrize("key", SORT_KEYS)
def test_sorted_output_is_an_ordered_permutation(spark, sf_dir, key):
    records = feeds.lineitems(spark, sf_dir)
    table = sorted_table(records, SORT_KEYS[key], new_run_dir(spark, "sorted"))
    assert table.exceptAll(records).isEmpty() and records.exceptAll(table).isEmpty()
    rows = parse_records(with_line_numbers(table)).orderBy("line_no").select("line_no", key, "raw").collect()
    assert [r.line_no for r in rows] == list(range(1, len(rows) + 1))
    pairs = [(r[key], r.raw) for r in rows]
    assert pairs == sorted(pairs)
    again = sorted_table(table, SORT_KEYS[key], new_run_dir(spark, "sorted"))
    assert in_order(with_line_numbers(again).orderBy("line_no")) == [r.raw for r in rows]


def partition_sizes(df) -> list[int]:
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_low_cardinality_key_uses_every_partition(spark, sf_dir):
    records = feeds.lineitems(spark, sf_dir)
    assert parse_records(records, "continent").select("continent").distinct().count() == 7
    sizes = partition_sizes(global_sort(records, ["continent"], 24))
    assert len(sizes) == 24
    assert max(sizes) < 2 * sum(sizes) / 24


def test_one_record_may_be_a_third_of_all_rows(spark):
    same = spark.range(0, 40_000, 1, 4).select(F.lit("5,same,record,Asia").alias("raw"))
    source = generate_records(spark, 80_000, 3, 4).union(same)
    path = new_run_dir(spark, "skewed")
    source.write.parquet(path)
    skewed = spark.read.parquet(path)
    for key in SORT_KEYS.values():
        sizes = partition_sizes(global_sort(skewed, key, 24))
        assert sum(sizes) == 120_000
        assert max(sizes) < 2 * 120_000 / 24
    table = sorted_table(skewed, ["name"], new_run_dir(spark, "sorted"), 24)
    assert table.exceptAll(skewed).isEmpty() and skewed.exceptAll(table).isEmpty()


def test_partition_count_follows_the_bytes_scanned(spark, sf_dir, monkeypatch):
    assert sort_partitions(feeds.lineitems(spark, sf_dir)) <= 8
    monkeypatch.setattr("tallyline.session.scan_bytes", lambda df: 100 * 2**40)
    assert sort_partitions(feeds.lineitems(spark, sf_dir)) == 32_768
    monkeypatch.setattr("tallyline.session.scan_bytes", lambda df: 2**30)
    assert sort_partitions(feeds.lineitems(spark, sf_dir)) == 64
    monkeypatch.undo()
    # A join's estimate is the product of its sides; only the scans count.
    assert sort_partitions(feeds.customers(spark, sf_dir)) == 1


def test_fanout_has_every_record_once_for_each_key(spark, sf_dir):
    records = feeds.orders(spark, sf_dir)
    copies = sort_fanout(records, new_run_dir(spark, "fanout"))
    counts = {r.sort_key: r["count"] for r in copies.groupBy("sort_key").count().collect()}
    assert counts == dict.fromkeys(SORT_KEYS, 15_000)


def test_shuffled_input_is_landed_before_the_sort(spark, sf_dir):
    scanned = feeds.customers(spark, sf_dir)
    assert repeatable(scanned) is scanned
    shuffled = scanned.repartition(5, "raw")
    landed = repeatable(shuffled)
    assert all("landed-" in path for path in landed.inputFiles())
    ordered = global_sort(shuffled, ["name"], 4)
    assert ordered.exceptAll(scanned).isEmpty() and scanned.exceptAll(ordered).isEmpty()


def test_custom_key(spark):
    df = spark.createDataFrame([("1,aaa,b,Asia",), ("2,a,c,Asia",), ("3,aa,a,Asia",)], "raw string")
    assert in_order(global_sort(df, [F.length("name")], 2)) == ["2,a,c,Asia", "3,aa,a,Asia", "1,aaa,b,Asia"]
    assert in_order(global_sort(df, [F.col("address").desc()], 2)) == ["2,a,c,Asia", "1,aaa,b,Asia", "3,aa,a,Asia"]


def test_merge_skips_folders_and_missing_runs(spark, tmp_path):
    (tmp_path / "run" / "inner").mkdir(parents=True)
    (tmp_path / "run" / "batch_1.csv").write_bytes(b"1,b,x,Asia\n3,a,x,Asia\r\n")
    (tmp_path / "run" / "batch_2.csv").write_bytes(b"2,c,x\rx,Asia\n")
    (tmp_path / "run" / "inner" / "batch_3.csv").write_bytes(b"9,z,x,Asia\n")
    merged = merge_runs(spark, [str(tmp_path / "run"), str(tmp_path / "none")], ["id"])
    assert in_order(merged) == ["1,b,x,Asia", "2,c,x\rx,Asia", "3,a,x,Asia"]
    assert scan_records(spark, str(tmp_path / "none")).collect() == []
    assert merge_runs(spark, [str(tmp_path / "none")], ["id"], 2).collect() == []


def test_written_bytes_are_the_records(spark):
    raws = ['1,"q", lead and trail ,Asia', "", "2,é,b,Asia", "x"]
    path = new_run_dir(spark, "bytes")
    assert write_lines(spark.createDataFrame([(r,) for r in raws], "raw string").coalesce(1), path) == 4
    lines = number_lines(read_lines(spark, path)).orderBy("line_no").collect()
    assert [r.line for r in lines] == raws


def test_outputs_are_never_overwritten(spark, sf_dir):
    root = new_run_dir(spark, "outputs")
    records = feeds.customers(spark, sf_dir)
    assert write_sorted_outputs(records, root) == dict.fromkeys(SORT_KEYS, 1500)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_sorted_outputs(records, root)
    assert {p.rsplit("/", 1)[1] for p in output_paths(root).values()} == {"id_sorted", "name_sorted", "continent_sorted"}


def test_line_numbers_do_not_depend_on_how_files_are_split(spark, sf_dir):
    path = new_run_dir(spark, "lines")
    write_lines(global_sort(feeds.lineitems(spark, sf_dir), ["name"], 5), path)
    whole = number_lines(read_lines(spark, path)).collect()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        lines = read_lines(spark, path)
        assert lines.select("file_path", "block_start").distinct().count() > 20
        split = number_lines(lines).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    key = lambda r: r.line_no
    assert [(r.line_no, r.line) for r in sorted(split, key=key)] == [(r.line_no, r.line) for r in sorted(whole, key=key)]
    assert [r.line_no for r in sorted(whole, key=key)] == list(range(1, 60_001))


def test_part_files_past_99999_keep_their_order(spark, tmp_path):
    for part, text in [("00009", "a"), ("99999", "b"), ("100000", "c"), ("1000000", "d")]:
        (tmp_path / f"part-{part}-x-c000.txt").write_text(text + "\n")
    (tmp_path / "part-99999-x-c001.txt").write_text("b2\n")
    lines = number_lines(read_lines(spark, str(tmp_path))).orderBy("line_no").collect()
    assert [r.line for r in lines] == ["a", "b", "b2", "c", "d"]


def test_rows_of_an_rdd_are_landed_and_sized(spark):
    made = spark.createDataFrame(spark.sparkContext.parallelize([("b",), ("a",)], 2), "raw string")
    landed = repeatable(made)
    assert landed is not made and scan_bytes(landed) is not None
    assert [r.raw for r in global_sort(made, ["raw"]).collect()] == ["a", "b"]


def test_a_path_named_like_a_plan_node_is_not_landed(spark, tmp_path):
    path = f"{tmp_path}/ShuffleExchangeExec"
    spark.range(3).selectExpr("cast(id as string) raw").write.parquet(path)
    table = spark.read.parquet(path)
    assert repeatable(table) is table


@pytest.fixture
def few_partitions(monkeypatch):
    """One shuffle makes at most four partitions, and far more are wanted."""
    monkeypatch.setattr(session, "MAX_SORT_PARTITIONS", 4)
    monkeypatch.setattr(session, "TARGET_PARTITION_BYTES", 4096)


def _sorted_in_two_steps(spark, records, by, path):
    table = sorting.sorted_table(records, by, path)
    numbered = with_line_numbers(table).orderBy("line_no").collect()
    assert [r["line_no"] for r in numbered] == list(range(1, len(numbered) + 1))
    return [r["raw"] for r in numbered]


def test_a_sort_in_two_steps(spark, few_partitions):
    """The same records repeated for a third of the table, and two names only."""
    made = generate_records(spark, 6000, 3, 3).unionByName(spark.range(3000).select(F.lit("7,same,a,Asia").alias("raw")))
    records = session.repeatable(made.repartition(3))
    raws = [r["raw"] for r in records.collect()]
    for by, key in ((["id"], lambda x: (int(x.split(",")[0]), x)), (["continent"], lambda x: (x.split(",")[3], x))):
        path = new_run_dir(spark, "two-steps")
        assert _sorted_in_two_steps(spark, records, by, path) == sorted(raws, key=key)
        ranges = [n for n in os.listdir(path) if n.startswith("range-")]
        assert len(ranges) > 3
        # Also as one frame, whose partitions follow one another.
        ordered = sorting.global_sort(records, by)
        assert ordered.rdd.getNumPartitions() > 8
        out = new_run_dir(spark, "two-steps")
        write_lines(ordered, out)
        assert [r["line"] for r in read_numbered(spark, {"x": out}).orderBy("line_no").collect()] == sorted(raws, key=key)


def test_a_sort_in_two_steps_goes_on_where_it_failed(spark, few_partitions, monkeypatch):
    records = session.repeatable(generate_records(spark, 5000, 3, 3).repartition(2))
    path, made, calls = new_run_dir(spark, "two-steps"), sorting.write_table, []

    def failing(df, target, *more):
        calls.append(os.path.basename(target))
        if len(calls) == 3:
            raise OSError("lost")
        made(df, target, *more)

    monkeypatch.setattr(sorting, "write_table", failing)
    with pytest.raises(OSError):
        sorting.sorted_table(records, ["name"], path)
    assert calls == ["coarse", "range-00000", "range-00001"]
    raws = _sorted_in_two_steps(spark, records, ["name"], path)
    assert calls[3:5] == ["range-00001", "range-00002"] and "coarse" not in calls[3:]
    assert raws == sorted((r["raw"] for r in records.collect()), key=lambda x: (x.split(",")[1], x))


def test_ranges_of_two_steps_stay_small(spark, few_partitions, monkeypatch):
    """A session's low bound does not make the ranges as large as the table over the bound."""
    monkeypatch.setattr(session, "COARSE_RANGE_BYTES", 8192)
    monkeypatch.setattr(session, "MAX_SORT_PARTITIONS", 64)
    records = session.repeatable(generate_records(spark, 12_000, 3, 3).repartition(2))
    low = spark.newSession()
    low.conf.set(session.MAX_SORT_PARTITIONS_KEY, "2")
    records = low.read.schema("raw string").parquet(*records.inputFiles())
    path = new_run_dir(spark, "two-steps")
    raws = _sorted_in_two_steps(spark, records, ["name"], path)
    assert raws == sorted((r["raw"] for r in records.collect()), key=lambda x: (x.split(",")[1], x))
    sizes = [low.read.parquet(f"{path}/coarse/{f}").count() for f in os.listdir(f"{path}/coarse") if f.startswith("part-")]
    assert len(sizes) > 8 and max(sizes) < 12_000 / 4


def test_partitions_of_a_hundred_terabytes():
    """No partition of more than 64 MiB, and no shuffle of more than the bound."""
    total_bytes, bound = 100 * 10**12, session.MAX_SORT_PARTITIONS
    wanted = -(-total_bytes // session.TARGET_PARTITION_BYTES)
    rng = random.Random(1)
    weights = [rng.uniform(0.5, 1.5) for _ in range(bound)]
    sizes = [int(total_bytes * w / sum(weights)) for w in weights]
    stretches = sorting.stretches_of_ranges(sizes, wanted, bound)
    assert [a for a, _, _ in stretches] == [0, *(b for _, b, _ in stretches[:-1])] and stretches[-1][1] == bound
    for a, b, n in stretches:
        assert n <= bound and sum(sizes[a:b]) / n <= 64 * session.MIB


def test_stretches_of_no_and_empty_and_huge_ranges():
    assert sorting.stretches_of_ranges([], 5, 4) == []
    assert sorting.stretches_of_ranges([0, 0], 5, 4) == [(0, 2, 1)]
    assert sorting.stretches_of_ranges([10, 1000, 10], 102, 4) == [(0, 1, 1), (1, 2, 100), (2, 3, 1)]
