"""Ordered line files, written together with a manifest of what is in them.

Each task writes the lines it has, in the order it has them, to files of its
own, and sends on one short row a file: its place in the order, lines, bytes,
and marks, that is line numbers and byte offsets at some steps. The rows are
the manifest, a Parquet table in the folder. Only files of tasks that Spark
committed are in it; what a lost attempt left behind is removed, and
``_SUCCESS`` is written last.

With the manifest a line's number is known without counting lines, a few lines
can be read without the rest, and files need no shuffle to come into order.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyline.session import write_table
from tallyline.sources.lines import delete_files, folder_names, make_folder, path_exists, qualified, touch
from tallyline.sources.ordered import MANIFEST, MANIFEST_SCHEMA, opener

# Bytes between two marks of a small file, and marks a file has at most: the
# steps of a large file are wider.
STEP = 16 * 1024
MAX_MARKS = 2048


def _part_writer(root: str, step: int, max_marks: int):
    """A function that writes a task's lines; made inside a function so that it travels to the executors by value."""
    open_store = opener()

    def write(batches: Iterator) -> Iterator:
        import uuid

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        store, folder = open_store(root)
        task, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        part: dict | None = None

        def begin(number: int, first: int) -> dict:
            # Names in the order of their lines, for whoever reads the folder without the manifest.
            name = f"part-{number:05d}-{first:012d}-{attempt}.txt"
            stream = store.open_output_stream(f"{folder}/{name}")
            return {"part": number, "first": first, "next": first, "file": name, "lines": 0, "bytes": 0, "marks": [(0, 0)], "step": step, "stream": stream}

        def add(part: dict, raw: pa.Array) -> None:
            ended = pc.binary_join_element_wise(raw, "", "\n", null_handling="replace", null_replacement="")
            offsets = np.frombuffer(ended.buffers()[1], np.int32)[ended.offset : ended.offset + len(ended) + 1]
            data = np.frombuffer(ended.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
            part["stream"].write(pa.py_buffer(data))
            # Line ends, those inside of records among them.
            starts = np.flatnonzero(data == 10) + (part["bytes"] + 1)
            while (k := int(np.searchsorted(starts, part["marks"][-1][1] + part["step"]))) < len(starts):
                part["marks"].append((part["lines"] + k + 1, int(starts[k])))
                if len(part["marks"]) > max_marks:
                    part["marks"], part["step"] = part["marks"][::2], 2 * part["step"]
            part["lines"] += len(starts)
            part["bytes"] += len(data)
            part["next"] += len(raw)

        def end(part: dict) -> pa.RecordBatch:
            part["stream"].close()
            if part["marks"][-1][1] == part["bytes"] and part["bytes"]:
                part["marks"].pop()
            marks = [{"line": line, "byte": byte} for line, byte in part["marks"]]
            columns = [pa.array([part[c]], pa.int64()) for c in ("part", "first")] + [pa.array([part["file"]])]
            columns += [pa.array([part[c]], pa.int64()) for c in ("lines", "bytes")]
            columns.append(pa.array([marks], pa.list_(pa.struct([("line", pa.int64()), ("byte", pa.int64())]))))
            return pa.RecordBatch.from_arrays(columns, names=["part", "first", "file", "lines", "bytes", "marks"])

        for batch in batches:
            if not batch.num_rows:
                continue
            raw, cuts = batch.column("raw"), [0, batch.num_rows]
            if placed := "part" in batch.schema.names:
                numbers, places = batch.column("part").to_numpy(), batch.column("place").to_numpy()
                jumps = np.flatnonzero((numbers[1:] != numbers[:-1]) | (places[1:] != places[:-1] + 1)) + 1
                cuts = [0, *jumps.tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                number, first = (int(numbers[a]), int(places[a])) if placed else (task, part["next"] if part else 0)
                if part and (part["part"], part["next"]) != (number, first):
                    yield end(part)
                    part = None
                part = part or begin(number, first)
                add(part, raw[a:b])
        if part:
            yield end(part)

    return write


def write_lines(rows: DataFrame, path: str) -> int:
    """Write ``raw`` as lines into a new folder; returns the lines written.

    The lines' order is that of the tasks and of the rows in them, or, if the
    rows have them, of the columns ``part`` and ``place``. Every task must then
    have its rows in stretches of consecutive places of one part; each stretch
    becomes a file.
    """
    spark = rows.sparkSession
    if path_exists(spark, path):
        raise FileExistsError(f"[PATH_ALREADY_EXISTS] {path}: an output is never added to or replaced")
    make_folder(spark, path)
    written = Observation()
    columns = [c for c in ("part", "place", "raw") if c in rows.columns]
    parts = rows.select(columns).mapInArrow(_part_writer(qualified(spark, path), STEP, MAX_MARKS), MANIFEST_SCHEMA)
    totals = F.coalesce(F.sum("lines"), F.lit(0)).alias("lines"), F.count(F.lit(1)).alias("files")
    write_table(parts.observe(written, *totals), f"{path}/{MANIFEST}")
    names = [n for n in folder_names(spark, path) if n.startswith("part-")]
    if len(names) != written.get["files"]:
        kept = {r[0] for r in spark.read.parquet(f"{path}/{MANIFEST}").select("file").collect()}
        delete_files(spark, path, [n for n in names if n not in kept])
    touch(spark, f"{path}/_SUCCESS")
    return written.get["lines"]
