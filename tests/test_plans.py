"""The physical plans are the ones the scale notes in the README promise."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tallyline.operators import checks, sampling
from tallyline.operators.positions import number_lines, with_line_numbers
from tallyline.operators.sorting import SORT_KEYS, global_sort, sorted_table
from tallyline.plans import catalog, feeds
from tallyline.session import new_run_dir
from tallyline.sinks.ordered import write_lines
from tallyline.sources.lines import read_lines


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text: str) -> list[str]:
    return re.findall(r"(?<!Broadcast)Exchange (\w+)", text)


@pytest.fixture(scope="module")
def table(spark, sf_dir):
    return sorted_table(feeds.lineitems(spark, sf_dir), ["name"], new_run_dir(spark, "sorted"))


@pytest.fixture(scope="module")
def text(spark, sf_dir):
    path = new_run_dir(spark, "text")
    write_lines(global_sort(feeds.lineitems(spark, sf_dir), ["name"]), path)
    return path


@pytest.mark.parametrize("key", SORT_KEYS)
def test_a_sort_is_one_range_shuffle_of_the_record_and_its_key(spark, table, key):
    p = plan(global_sort(table, [key]))
    assert exchanges(p) == ["rangepartitioning"]
    assert "ReadSchema: struct<raw:string>" in p
    assert "Python" not in p and "Arrow" not in p
    others = [f for f in SORT_KEYS if f != key]
    assert not any(re.search(rf"AS {f}#", p) for f in others)


def test_unused_columns_are_not_read(spark, sf_dir):
    p = plan(feeds.lineitems(spark, sf_dir))
    assert "l_comment" not in p and "l_extendedprice" not in p and "l_quantity" not in p


def data_side(p: str) -> str:
    """The plan above and beside the broadcast side of its join."""
    return p.split("BroadcastExchange")[0]


def test_line_numbers_do_not_move_the_data(spark, table, text):
    assert exchanges(data_side(plan(with_line_numbers(table)))) == []
    assert "BroadcastHashJoin" in plan(with_line_numbers(table))
    assert exchanges(data_side(plan(number_lines(read_lines(spark, text))))) == []


def test_rows_per_file_come_from_the_footers(spark, table):
    p = plan(with_line_numbers(table)).split("BroadcastExchange")[1]
    assert "ReadSchema: struct<>" in p


def test_order_check_moves_one_row_per_split(spark, text):
    p = plan(checks.order_check(spark, {"name": text}))
    below = p.split("MapInArrow")[1]
    assert exchanges(below) == []
    assert exchanges(p) == ["SinglePartition"]


def test_large_file_tables_are_not_broadcast(spark, table, monkeypatch):
    monkeypatch.setattr("tallyline.operators.positions.MAX_BROADCAST_ROWS", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbered = with_line_numbers(table)
        assert "BroadcastHashJoin" not in plan(numbered)
        assert numbered.agg(F.min("line_no"), F.max("line_no"), F.count_distinct("line_no")).first() == (1, 60_000, 60_000)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_head_keeps_n_rows_per_task(spark, sf_dir):
    p = plan(sampling.head(feeds.lineitems(spark, sf_dir), ["id"]))
    assert "TakeOrderedAndProject" in p and exchanges(p) == []


def test_aggregates_combine_before_the_shuffle(spark, sf_dir):
    p = plan(catalog.batches(spark, sf_dir))
    assert "partial_count" in p and "partial_sum" in p


def test_middle_sample_reads_few_files(spark, sf_dir):
    path = new_run_dir(spark, "sorted")
    sorted_table(feeds.lineitems(spark, sf_dir), ["name"], path, 50)
    report = sampling.sample_tables(spark, {"name": path})
    assert report.where("section = 'mid'").count() == 3
    read = [f for f in report.inputFiles() if "part-" in f]
    assert 1 <= len(read) <= 9
