"""Random records as a table-generation job: every row follows from its number and a seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.records import encode_record, work_prefix

# The domains of a generated record. Names are of a-z and A-Z,
# addresses of a-z, A-Z, 0-9 and the space.
NAME_LENGTH = (10, 15)
ADDRESS_LENGTH = (15, 20)
CONTINENTS = ("Asia", "Africa", "Australia", "Europe", "North America", "South America")
MAX_ID = 2**31 - 1

# About 128 MiB of records: what one task generates unless told otherwise.
RECORDS_PER_TASK = 2_500_000


def _digest(row: Column, seed: int, tag: str) -> Column:
    """32 random bytes as hex. rand(seed) would change with the partitioning."""
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), row.cast("string"), F.lit(tag)), 256)


def _number(digest: Column, start: int, digits: int) -> Column:
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("bigint")


def _length(draw: Column, bounds: tuple[int, int]) -> Column:
    low, high = bounds
    return (draw % (high - low + 1) + low).cast("int")


def _fit(symbols: Column, length: Column) -> Column:
    """Cut to ``length``; a digest that left too few symbols (one in 10^9) is filled up with 'a'."""
    return F.rpad(symbols, length, "a")


def records_for(df: DataFrame, row: str, seed: int = 0) -> DataFrame:
    """Add ``raw``, a random record, to every row; ``row`` is the column that tells rows apart."""
    mark = work_prefix(df.columns)
    drawn = df.withColumns(
        {f"{mark}first": _digest(F.col(row), seed, "first"), f"{mark}second": _digest(F.col(row), seed, "second")}
    )
    first, second = F.col(f"{mark}first"), F.col(f"{mark}second")
    # Base 64 has all the letters and digits. Taking out what a field does not
    # use leaves its characters evenly likely; '+' stands in for the space.
    letters = F.regexp_replace(F.base64(F.unhex(first)), "[^a-zA-Z]+", "")
    spaced = F.replace(F.base64(F.unhex(F.substring(second, 1, 42))), F.lit("+"), F.lit(" "))
    raw = encode_record(
        _number(second, 43, 8) % (MAX_ID + 1),
        _fit(letters, _length(_number(second, 57, 4), NAME_LENGTH)),
        _fit(F.replace(spaced, F.lit("/"), F.lit("")), _length(_number(second, 61, 4), ADDRESS_LENGTH)),
        F.element_at(
            F.array(*map(F.lit, CONTINENTS)), (_number(second, 51, 6) % len(CONTINENTS) + 1).cast("int")
        ),
    )
    return drawn.select(*df.columns, raw.alias("raw"))


def spread(rows: DataFrame, row: str) -> DataFrame:
    """Short rows dealt to all cores if their scan has fewer tasks: a record is far more work than the row it is made for."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores, row) if rows.rdd.getNumPartitions() < cores else rows


def generate_records(spark: SparkSession, n: int, seed: int = 0, num_partitions: int | None = None) -> DataFrame:
    """Exactly max(n, 0) records; the same ones for a seed whatever the partitioning."""
    if num_partitions is not None and num_partitions <= 0:
        raise ValueError("num_partitions must be positive")
    n = max(n, 0)
    tasks = num_partitions or max(spark.sparkContext.defaultParallelism, -(-n // RECORDS_PER_TASK))
    rows = spark.range(0, n, 1, tasks)
    return records_for(rows, "id", seed).select("raw")
