"""Acceptance checks on sorted outputs: how many lines, and are they in order."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.functions.records import parse_records, strip_line_end
from tallyline.operators.positions import running_offsets
from tallyline.session import union_all
from tallyline.sources.lines import FILE_ORDER, line_files, read_lines


def count_per_output(spark: SparkSession, outputs: Mapping[str, str]) -> DataFrame:
    """(output, lines) for every output directory; 0 where there is none."""
    # A global count keeps its row when there is nothing to count.
    return union_all(
        [
            read_lines(spark, path).agg(F.count(F.lit(1)).alias("lines")).select(F.lit(name).alias("output"), "lines")
            for name, path in outputs.items()
        ]
    )


def count_check(counts: DataFrame, expected: int | Column) -> DataFrame:
    """(output, expected, actual, ok) from (output, lines)."""
    wanted = expected if isinstance(expected, Column) else F.lit(expected)
    return counts.select(
        "output",
        wanted.cast("bigint").alias("expected"),
        F.col("lines").alias("actual"),
        (F.col("lines") == wanted).alias("ok"),
    )


def _summarise_splits():
    """A function that folds the lines of each file split into one row.

    Made inside a function so that it travels to the executors by value: they
    need numpy and pyarrow but not this package.
    """

    def differs(column: pa.Array) -> np.ndarray:
        return pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The lines of a split reach the task in file order, one split after
        # the other, so only the summary of the open split has to be kept.
        open_split, schema = None, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            file, block_start, key = (batch.column(name) for name in ("file", "block_start", "key"))
            schema = schema or pa.schema(
                [
                    ("file", pa.int64()),
                    ("block_start", pa.int64()),
                    ("rows", pa.int64()),
                    ("first_key", key.type),
                    ("last_key", key.type),
                    ("violations", pa.int64()),
                    ("first_violation", pa.int64()),
                ]
            )
            descends = pc.less(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(differs(file) | differs(block_start)) + 1
            edges = [0, *starts.tolist(), batch.num_rows]
            for begin, end in zip(edges, edges[1:]):
                place = {"file": file[begin].as_py(), "block_start": block_start[begin].as_py()}
                if open_split and any(open_split[name] != place[name] for name in place):
                    yield pa.RecordBatch.from_pylist([open_split], schema=schema)
                    open_split = None
                lower = np.flatnonzero(descends[begin : end - 1]) + 2  # 1-based place of the lower line
                if open_split is None:
                    open_split = place | {
                        "rows": 0,
                        "first_key": key[begin].as_py(),
                        "violations": 0,
                        "first_violation": None,
                    }
                elif pc.less(key[begin], pa.scalar(open_split["last_key"], key.type)).as_py():
                    lower = np.concatenate(([1], lower))
                if len(lower) and open_split["first_violation"] is None:
                    open_split["first_violation"] = open_split["rows"] + int(lower[0])
                open_split["violations"] += len(lower)
                open_split["rows"] += end - begin
                open_split["last_key"] = key[end - 1].as_py()
        if open_split:
            yield pa.RecordBatch.from_pylist([open_split], schema=schema)

    return summarise


def split_summaries(spark: SparkSession, path: str, key: str | Column) -> DataFrame:
    """Per file split of an output: lines, first and last key, descents and the first of them.

    A window would shuffle and sort every line to recover an order the files
    already have. Here each task reads its splits once and sends on one row. A
    line brings its key and two numbers: a hash of its file's path, and where
    its split starts. The paths come from a listing of the folder.
    """
    records = read_lines(spark, path).withColumn("raw", strip_line_end(F.col("line")))
    if isinstance(key, str):
        records, key = parse_records(records, key), F.col(key)
    keyed = records.select(F.xxhash64("file_path").alias("file"), "block_start", key.alias("key"))
    key_type = keyed.schema["key"].dataType.simpleString()
    splits = keyed.mapInArrow(
        _summarise_splits(),
        "file long, block_start long, rows long, "
        f"first_key {key_type}, last_key {key_type}, violations long, first_violation long",
    )
    return splits.join(line_files(spark, path), "file").drop("file")


def order_of_splits(splits: DataFrame) -> DataFrame:
    """(lines, violations, first_violation) over the splits of one output."""
    before = F.lag("last_key").over(Window.orderBy(*FILE_ORDER, "block_start"))
    chained = running_offsets(splits, "block_start").withColumn("crossing", F.col("first_key") < before)
    crossing = F.coalesce(F.col("crossing"), F.lit(False))
    first = F.col("offset") + F.when(crossing, F.lit(1)).otherwise(F.col("first_violation"))
    return chained.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("lines"),
        F.coalesce(F.sum(F.col("violations") + crossing.cast("bigint")), F.lit(0)).alias("violations"),
        F.min(first).alias("first_violation"),
    )


def order_check(
    spark: SparkSession, outputs: Mapping[str, str], keys: Mapping[str, str | Column] | None = None
) -> DataFrame:
    """(output, lines, violations, first_violation) for every output directory.

    A line is a violation if its key is below the key of the line before it;
    ``first_violation`` is its line number, null in an ordered output. ``keys``
    names the field, or gives an expression over ``raw``, to check an output
    by; the default is the field named like the output.
    """

    return order_of_outputs(
        {name: split_summaries(spark, path, (keys or {}).get(name, name)) for name, path in outputs.items()}
    )


def order_of_outputs(splits: Mapping[str, DataFrame]) -> DataFrame:
    return union_all(
        order_of_splits(rows).select(F.lit(name).alias("output"), "lines", "violations", "first_violation")
        for name, rows in splits.items()
    )
