"""Ordered line files read by their manifest: numbered lines, a few lines, all lines in order.

The manifest (see ``sinks.ordered``) has a row for each file. Line numbers of
files come from adding up that table; its marks cut files into stretches of
known first line, which tasks read by byte range. No line is moved or counted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.session import MIB, union_all
from tallyline.sources.lines import path_exists, qualified

MANIFEST = "_manifest"
MANIFEST_SCHEMA = "part long, first long, file string, lines long, bytes long, marks array<struct<line: long, byte: long>>"
# Bytes a task reads.
READ_BYTES = 64 * MIB

NUMBERED = "output string, line_no long, line string"


def opener():
    """A function that opens a folder's file system in a task."""

    def open_store(root: str) -> tuple:
        import re
        from urllib.parse import quote

        from pyarrow import fs

        if root.startswith("file:"):
            return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", root)
        return fs.FileSystem.from_uri(quote(root, safe=":/?=&@%"))

    return open_store


def has_manifest(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/{MANIFEST}/_SUCCESS")


def manifest(spark: SparkSession, outputs: Mapping[str, str]) -> DataFrame:
    """The files of all outputs: output, root, file, lines, bytes, marks, and ``offset``, the lines before a file."""
    files = union_all(
        spark.read.schema(MANIFEST_SCHEMA).parquet(f"{path}/{MANIFEST}").withColumns({"output": F.lit(name), "root": F.lit(qualified(spark, path))})
        for name, path in outputs.items()
    )
    # One short row a file: some 30,000 for 100 TB.
    before = Window.partitionBy("output").orderBy("part", "first", "file").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumns({"offset": F.coalesce(F.sum("lines").over(before), F.lit(0)), "start": F.coalesce(F.sum("bytes").over(before), F.lit(0))})


def stretches(files: DataFrame) -> DataFrame:
    """Byte ranges between marks: output, root, file, low, high (bytes), first and last (line numbers), start (byte in the output)."""
    at = F.posexplode("marks").alias("k", "mark")
    cut = files.where("lines > 0").select("*", at)
    after = F.try_element_at("marks", F.col("k") + 2)
    return cut.select(
        "output",
        "root",
        "file",
        F.col("mark.byte").alias("low"),
        F.coalesce(after["byte"], F.col("bytes")).alias("high"),
        (F.col("offset") + F.col("mark.line") + 1).alias("first"),
        (F.col("offset") + F.coalesce(after["line"], F.col("lines"))).alias("last"),
        (F.col("start") + F.col("mark.byte")).alias("start"),
    )


def _range_reader(piece_bytes: int):
    """A function that reads byte ranges of files as numbered lines; it travels to the executors by value."""
    open_store = opener()

    def read(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def lines(stream, low: int, high: int, first: int) -> Iterator[tuple[int, pa.Array]]:
            rest = b""
            while low < high:
                data = rest + stream.read_at(min(piece_bytes, high - low), low)
                low += len(data) - len(rest)
                # A line may go on in the next piece.
                cut = data.rfind(b"\n") + 1
                if not cut:
                    rest = data
                    continue
                whole, rest = np.frombuffer(data, np.uint8, cut), data[cut:]
                ends = np.flatnonzero(whole == 10)
                offsets = np.concatenate([[0], ends - np.arange(len(ends))]).astype(np.int32)
                text = whole[whole != 10].tobytes()
                yield first, pa.Array.from_buffers(pa.string(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(text)])
                first += len(ends)

        for batch in batches:
            for r in batch.to_pylist():
                store, folder = open_store(r["root"])
                with store.open_input_file(f"{folder}/{r['file']}") as stream:
                    for first, found in lines(stream, r["low"], r["high"], r["first"]):
                        columns = [pa.repeat(r["output"], len(found)), pa.array(np.arange(first, first + len(found))), found]
                        yield pa.RecordBatch.from_arrays(columns, names=["output", "line_no", "line"])

    return read


def read_stretches(ranges: DataFrame) -> DataFrame:
    """(output, line_no, line) of the stretches' lines."""
    return ranges.select("output", "root", "file", "low", "high", "first").mapInArrow(_range_reader(8 * MIB), NUMBERED)


def read_numbered(spark: SparkSession, outputs: Mapping[str, str]) -> DataFrame:
    """(output, line_no, line) of whole outputs, each read once.

    What is dealt out to tasks is the table of byte ranges. Neighbouring ranges
    of a file go to one task as one range.
    """
    files = manifest(spark, outputs)
    total = files.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    cores = spark.sparkContext.defaultParallelism
    size = max(1, min(READ_BYTES, math.ceil(total / cores)))
    each = stretches(files).withColumn("task", F.floor(F.col("start") / size))
    joined = each.groupBy("output", "root", "file", "task").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.min("first").alias("first"))
    return read_stretches(joined.repartition(max(1, math.ceil(total / size)), "output", "file", "task"))


def read_lines_between(spark: SparkSession, outputs: Mapping[str, str], ranges) -> DataFrame:
    """(output, total, line_no, line) of the lines in some ranges; reads the stretches they lie in.

    ``ranges`` gives pairs of first and last line number from the column of an output's total.
    """
    files = manifest(spark, outputs)
    totals = files.groupBy("output").agg(F.sum("lines").alias("total"))
    wanted = [(low, high) for low, high in ranges(F.col("total"))]
    overlap = lambda a, b: F.array(*((a <= high) & (b >= low) for low, high in wanted))
    any_of = lambda x: F.exists(x, lambda v: v)
    near = stretches(files).join(F.broadcast(totals), "output").where(any_of(overlap(F.col("first"), F.col("last"))))
    lines = read_stretches(near).join(F.broadcast(totals), "output")
    return lines.where(any_of(overlap(F.col("line_no"), F.col("line_no")))).select("output", "total", "line_no", "line")
