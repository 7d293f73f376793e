"""Total sorts of records by any key, one sorted copy per key."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from math import ceil

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.records import FIELDS, parse_records
from tallyline.operators.positions import with_line_numbers
from tallyline.session import coarse_partitions, max_sort_partitions, new_run_dir, repeatable, union_all, wanted_partitions, write_table
from tallyline.sources.lines import file_sizes, path_exists, scan_records

SortKey = Sequence["str | Column"]

# The keys every run sorts by. A caller may pass its own mapping: any columns
# or expressions over raw and the record's fields.
SORT_KEYS: dict[str, SortKey] = {
    "id": ("id",),
    "name": ("name",),
    "continent": ("continent",),
}


def with_sort_columns(df: DataFrame, by: SortKey) -> tuple[DataFrame, list[Column]]:
    """``raw`` with the fields ``by`` names, and the order: ``by``, then ``raw``."""
    named = [c for c in by if isinstance(c, str)]
    # An expression may use any field; the optimizer drops those it does not.
    fields = FIELDS if len(named) < len(by) else [c for c in named if c in FIELDS]
    records = df.select("raw")
    order = [F.col(c) if isinstance(c, str) else c for c in by] + [F.col("raw")]
    return (parse_records(records, *fields) if fields else records), order


def _ranged(df: DataFrame, by: SortKey, num_partitions: int) -> tuple[DataFrame, list[Column]]:
    """Records dealt to ranges of (key, raw, row position), and the order within them."""
    records, order = with_sort_columns(df, by)
    return records.repartitionByRange(num_partitions, *order, F.monotonically_increasing_id()), order


def global_sort(df: DataFrame, by: SortKey, num_partitions: int | None = None) -> DataFrame:
    """All records of ``df`` in ascending order of ``by``, equal keys by ``raw``.

    The rows are range partitioned on (key, raw, row position), so neither a
    key with few values nor one record repeated many times has to fit into one
    partition. The position only spreads equal records; it is not sorted on.
    A lost task has to find its rows at the same positions again, so input
    that comes out of a shuffle is landed first.

    Records that need more partitions than one shuffle makes are landed in
    coarse ranges first, and stretches of those are sorted by themselves.
    """
    df = repeatable(df.select("raw"))
    if not num_partitions and wanted_partitions(df) > max_sort_partitions(df.sparkSession):
        return union_all(global_sort(part, by, n) for part, n in coarse_ranges(df, by, new_run_dir(df.sparkSession, "ranges")))
    ranged, order = _ranged(df, by, num_partitions or wanted_partitions(df))
    return ranged.sortWithinPartitions(*order).select("raw")


def stretches_of_ranges(sizes: Sequence[int], total: int, at_most: int) -> list[tuple[int, int, int]]:
    """Neighbouring ranges to be sorted together: (first, one after the last, partitions).

    ``total`` partitions are shared out by size; a stretch gets at most
    ``at_most`` of them, unless it is a single range that needs more.
    """
    each = sum(sizes) / max(total, 1)
    out: list[tuple[int, int, int]] = []
    first, size = 0, 0
    for k, own in enumerate([*sizes, None]):
        if k > first and (own is None or size + own > each * at_most):
            out.append((first, k, max(1, ceil(size / each)) if each else 1))
            first, size = k, 0
        size += own or 0
    return out


def coarse_ranges(df: DataFrame, by: SortKey, path: str) -> list[tuple[DataFrame, int]]:
    """The records in stretches of ranges that follow one another, each with the partitions its sort needs.

    The ranges are written as they come out of the shuffle, unsorted: a task
    streams its range into a file and holds none of it. There are as many as
    one shuffle makes, or more where a task would have to read too much. Ranges
    that are there from an earlier attempt are taken as they are.
    """
    spark = df.sparkSession
    at_most, total = max_sort_partitions(spark), wanted_partitions(df)
    if not path_exists(spark, f"{path}/_SUCCESS"):
        write_table(_ranged(df, by, coarse_partitions(df))[0].select("raw"), path, "overwrite")
    files = sorted((int(name.split("-")[1]), name, size) for name, size in file_sizes(spark, path) if name.startswith("part-"))
    reader = spark.read.schema("raw string")
    return [
        (reader.parquet(*(f"{path}/{name}" for _, name, _ in files[a:b])), n)
        for a, b, n in stretches_of_ranges([size for _, _, size in files], total, at_most)
    ]


def for_each_key(spark: SparkSession, keys: Mapping[str, SortKey], job: Callable[[str, SortKey], object]) -> dict:
    """Run one job per key at the same time, so one key's tail overlaps another's start."""
    threaded = inheritable_thread_target(spark)(job)
    with ThreadPoolExecutor(max_workers=len(keys)) as pool:
        # Each thread in a copy of the caller's context, for what belongs to the step at hand.
        running = {key: pool.submit(copy_context().run, threaded, key, by) for key, by in keys.items()}
        return {key: future.result() for key, future in running.items()}


def sorted_table(df: DataFrame, by: SortKey, path: str, num_partitions: int | None = None) -> DataFrame:
    """Write the sorted records as Parquet and read them back.

    Sampled range boundaries are not repeatable; the written files are. A sort
    in two steps writes a folder for each stretch of ranges; if there are more
    ranges than one shuffle makes, stretches are small, and as many are sorted at
    the same time as there are cores for. Called again with the same path after
    a failure, it goes on with the stretches that are not there yet.
    """
    spark, reader = df.sparkSession, df.sparkSession.read.schema("raw string")
    df = repeatable(df.select("raw"))
    if num_partitions or wanted_partitions(df) <= max_sort_partitions(spark):
        write_table(global_sort(df, by, num_partitions), path)
        return reader.parquet(path)
    stretches = {f"{path}/range-{k:05d}": x for k, x in enumerate(coarse_ranges(df, by, f"{path}/coarse"))}
    waiting = [name for name in stretches if not path_exists(spark, f"{name}/_SUCCESS")]
    at_once = 1
    if coarse_partitions(df) > max_sort_partitions(spark):
        at_once = max(1, spark.sparkContext.defaultParallelism // max((n for _, n in stretches.values()), default=1))

    def sort(name: str, _) -> None:
        part, n = stretches[name]
        write_table(global_sort(part, by, n), name, "overwrite")

    for k in range(0, len(waiting), at_once):
        for_each_key(spark, dict.fromkeys(waiting[k : k + at_once], ()), sort)
    return reader.parquet(*stretches)


def sort_fanout(df: DataFrame, root: str, keys: Mapping[str, SortKey] = SORT_KEYS) -> DataFrame:
    """A numbered, fully sorted copy of the records for every key."""
    df = repeatable(df.select("raw"))
    tables = for_each_key(df.sparkSession, keys, lambda key, by: sorted_table(df, by, f"{root}/sorted_{key}"))
    copies = [
        with_line_numbers(table).select(F.lit(key).alias("sort_key"), "line_no", "raw")
        for key, table in tables.items()
    ]
    return union_all(copies)


def merge_runs(spark: SparkSession, paths: Sequence[str], by: SortKey, num_partitions: int | None = None) -> DataFrame:
    """Any number of run files as one sorted sequence."""
    return global_sort(scan_records(spark, *paths), by, num_partitions)
