from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyline.functions.records import parse_records
from tallyline.operators.generate import ADDRESS_LENGTH, CONTINENTS, NAME_LENGTH, generate_records, records_for, spread


@pytest.mark.parametrize("n,partitions", [(0, 3), (-5, 2), (1, 8), (1000, 7), (10, None)])
def test_exact_count(spark, n, partitions):
    assert generate_records(spark, n, 1, partitions).count() == max(n, 0)


@pytest.mark.parametrize("partitions", [0, -1])
def test_no_partitions_is_an_error(spark, partitions):
    with pytest.raises(ValueError):
        generate_records(spark, 10, 1, partitions)


def test_seed_decides_the_records_not_the_partitioning(spark):
    three, eight = generate_records(spark, 3000, 5, 3), generate_records(spark, 3000, 5, 8)
    assert three.exceptAll(eight).isEmpty() and eight.exceptAll(three).isEmpty()
    assert not three.exceptAll(generate_records(spark, 3000, 6, 3)).isEmpty()


def test_domains(spark):
    df = parse_records(generate_records(spark, 60_000, 2, 8))
    low, high = NAME_LENGTH
    assert df.where(~F.col("name").rlike(rf"\A[a-zA-Z]{{{low},{high}}}\z")).isEmpty()
    low, high = ADDRESS_LENGTH
    assert df.where(~F.col("address").rlike(rf"\A[a-zA-Z0-9 ]{{{low},{high}}}\z")).isEmpty()
    assert df.where((F.col("id") < 0) | (F.split("raw", ",")[0] != F.col("id").cast("string"))).isEmpty()
    counts = {r[0]: r[1] for r in df.groupBy("continent").count().collect()}
    assert set(counts) == set(CONTINENTS)
    assert all(9_500 < n < 10_500 for n in counts.values())
    lengths = {r[0]: r[1] for r in df.groupBy(F.length("name")).count().collect()}
    assert all(9_500 < n < 10_500 for n in lengths.values()) and len(lengths) == 6


@pytest.mark.parametrize("field,symbols", [("name", 52), ("address", 63)])
def test_characters_are_evenly_likely(spark, field, symbols):
    df = parse_records(generate_records(spark, 60_000, 3, 8), field)
    counts = [r[1] for r in df.select(F.explode(F.split(field, "")).alias("c")).groupBy("c").count().collect()]
    assert len(counts) == symbols
    mean = sum(counts) / symbols
    assert all(abs(n - mean) < 0.06 * mean for n in counts)


def test_few_row_groups_are_spread_over_the_cores(spark):
    rows = spark.range(0, 2000, 1, 1).withColumnRenamed("id", "row")
    assert spread(rows, "row").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = rows.repartition(40)
    assert spread(many, "row").rdd.getNumPartitions() == 40
    made, plain = (records_for(x, "row", 3) for x in (spread(rows, "row"), rows))
    assert made.exceptAll(plain).isEmpty() and plain.exceptAll(made).isEmpty()
