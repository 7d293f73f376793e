"""Head, middle and tail of ordered outputs, and the report made of them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.functions.records import parse_records
from tallyline.operators.positions import number_lines, running_offsets, table_rows
from tallyline.operators.sorting import SortKey, with_sort_columns
from tallyline.session import union_all
from tallyline.sources.lines import read_lines
from tallyline.sources.ordered import has_manifest, manifest, read_lines_between

SAMPLE = 3
SECTIONS = ("head", "total", "mid", "tail")  # in report order

SAMPLE_SCHEMA = "output string, section string, seq int, line_no long, line string"


def head(df: DataFrame, by: SortKey, n: int = SAMPLE) -> DataFrame:
    """The first n records in sort order; each task keeps n rows, nothing is sorted whole."""
    records, order = with_sort_columns(df, by)
    return records.orderBy(*order).limit(n).select("raw")


def tail(df: DataFrame, fields: list[str], n: int = SAMPLE) -> DataFrame:
    """The last n records with their line numbers in the sorted copy, in that order."""
    records, order = with_sort_columns(df, fields)
    last = records.orderBy(*[c.desc() for c in order]).limit(n)
    place = F.row_number().over(Window.orderBy(*[c.desc() for c in order]))
    # n rows from here on: the last of as many lines as there are.
    numbered = last.select((F.lit(df.count()) - place + 1).alias("line_no"), "raw")
    return numbered.orderBy("line_no")


def key_extremes(df: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """(output, first_raw, last_raw): the ends of every sorted copy in one pass."""
    parsed = parse_records(df.select("raw"), *dict.fromkeys(fields.values()))
    ends = []
    for name, field in fields.items():
        place = F.struct(field, "raw")
        ends += [F.min(place)["raw"].alias(f"{name}_first"), F.max(place)["raw"].alias(f"{name}_last")]
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("output"), F.col(f"{n}_first").alias("first_raw"), F.col(f"{n}_last").alias("last_raw"))
            for n in fields
        ]
    )
    return parsed.agg(*ends).select(F.inline(rows))


def _ranges(total: Column) -> dict[str, tuple[Column, Column]]:
    """First and last line number of each section."""
    middle = F.shiftright(total, 1)
    return {
        "head": (F.lit(1), F.lit(SAMPLE)),
        "mid": (middle, middle + (SAMPLE - 1)),
        "tail": (total - (SAMPLE - 1), total),
    }


def _wanted(line_no: Column, total: Column) -> Column:
    """The sections a line belongs to, as an array."""
    named = [F.when(line_no.between(low, high), F.lit(name)) for name, (low, high) in _ranges(total).items()]
    return F.array_compact(F.array(*named))


def _files_with_samples(counts: DataFrame) -> list:
    """Files that hold a sampled line: at most nine for each output."""
    placed = running_offsets(counts, within=["output"])
    totals = counts.groupBy("output").agg(F.sum("rows").alias("total"))
    first, last, total = F.col("offset") + 1, F.col("offset") + F.col("rows"), F.col("total")
    overlaps = [(first <= high) & (last >= low) for low, high in _ranges(total).values()]
    return placed.join(totals, "output").where(overlaps[0] | overlaps[1] | overlaps[2]).collect()


def _place_files(rows: DataFrame, files: list) -> DataFrame:
    """Section rows out of (file_path, in_file, line) of the files chosen above."""
    places = rows.sparkSession.createDataFrame(
        [(f["file_path"], f["output"], f["offset"], f["total"]) for f in files],
        "file_path string, output string, offset long, total long",
    )
    line_no = F.col("offset") + F.col("in_file")
    placed = rows.join(F.broadcast(places), "file_path").select("output", "total", line_no.alias("line_no"), "line")
    return _in_sections(placed)


def _in_sections(lines: DataFrame) -> DataFrame:
    """Section rows out of (output, total, line_no, line)."""
    line_no, total = F.col("line_no"), F.col("total")
    sampled = lines.select("output", "total", "line", "line_no", F.explode(_wanted(line_no, total)).alias("section"))
    first = F.coalesce(*[F.when(F.col("section") == name, low) for name, (low, _) in _ranges(total).items()])
    seq = F.col("line_no") - F.greatest(first, F.lit(1)) + 1
    return sampled.select("output", "section", seq.cast("int").alias("seq"), "line_no", "line")


def _report(spark: SparkSession, outputs: Iterable[str], total_of: Mapping[str, int], sections: DataFrame | None) -> DataFrame:
    totals = [(name, "total", 1, total_of.get(name, 0), None) for name in outputs]
    parts = [spark.createDataFrame(totals, SAMPLE_SCHEMA)]
    if sections is not None:
        parts.append(sections)
    return union_all(parts)


def _of_files(spark: SparkSession, outputs: Iterable[str], files: list, rows: DataFrame | None) -> DataFrame:
    sections = None if rows is None else _place_files(rows, files)
    return _report(spark, outputs, {f["output"]: f["total"] for f in files}, sections)


def _paths(files: list) -> list[str]:
    return [unquote(f["file_path"]) for f in files]


def sample_tables(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """Section rows of sorted Parquet tables; reads footers and at most nine files each."""
    reader = spark.read.schema("raw string")
    counts = union_all(
        table_rows(reader.parquet(path)).select(F.lit(name).alias("output"), "file_path", "rows")
        for name, path in tables.items()
    )
    files = _files_with_samples(counts)
    rows = None
    if files:
        rows = reader.parquet(*_paths(files)).select(
            F.col("_metadata.file_path").alias("file_path"),
            (F.col("_metadata.row_index") + 1).alias("in_file"),
            F.col("raw").alias("line"),
        )
    return _of_files(spark, tables, files, rows)


def lines_per_file(spark: SparkSession, outputs: Mapping[str, str]) -> DataFrame:
    """(output, file_path, rows) of text outputs."""
    return union_all(
        read_lines(spark, path)
        .groupBy("file_path")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(name).alias("output"), "file_path", "rows")
        for name, path in outputs.items()
    )


def sample_report(spark: SparkSession, outputs: Mapping[str, str], counts: DataFrame | None = None) -> DataFrame:
    """Section rows of sorted text outputs.

    Outputs with a manifest are not read but for the stretches the samples lie
    in, at most two marks around each. Others are read once to count their
    lines, unless ``counts`` already has the lines per file; after that only
    the files that hold a sampled line are read.
    """
    if all(has_manifest(spark, path) for path in outputs.values()):
        totals = manifest(spark, outputs).groupBy("output").agg(F.sum("lines").alias("total")).collect()
        lines = read_lines_between(spark, outputs, lambda total: _ranges(total).values())
        return _report(spark, outputs, {r["output"]: r["total"] for r in totals}, _in_sections(lines))
    counts = lines_per_file(spark, outputs) if counts is None else counts
    files = _files_with_samples(counts)
    rows = None
    if files:
        lines = number_lines(read_lines(spark, *_paths(files)), within=["file_path"])
        rows = lines.select("file_path", F.col("line_no").alias("in_file"), "line")
    return _of_files(spark, outputs, files, rows)


def report_lines(report: DataFrame, paths: Mapping[str, str]) -> DataFrame:
    """(line_no, text): the report as it is written, outputs in the order of ``paths``.

    The report has at most ten rows for each output, so one task orders it.
    """
    names = list(paths)
    output_no = F.array_position(F.array(*map(F.lit, names)), F.col("output"))
    path = F.element_at(F.array(*map(F.lit, paths.values())), output_no.cast("int"))
    section_no = F.array_position(F.array(*map(F.lit, SECTIONS)), F.col("section"))
    # Fixed report texts.
    text = F.when(
        F.col("section") == "total", F.format_string("total lines path=%s total_lines=%d", path, F.col("line_no"))
    ).otherwise(F.format_string("[%s] path=%s line=%s", F.col("section"), path, F.coalesce("line", F.lit(""))))
    body = report.select(output_no.alias("o"), section_no.alias("s"), F.col("seq").alias("q"), text.alias("text"))

    spark = report.sparkSession
    titles = []
    for i, p in enumerate(paths.values(), start=1):
        titles.append((i, 0, 0, f"start sampling path={p}"))
        titles += [
            (i, s, 0, f"=== {name} section === path={p}") for s, name in enumerate(SECTIONS, start=1) if name != "total"
        ]
    titled = body.unionByName(spark.createDataFrame(titles, "o long, s long, q int, text string"))
    numbered = titled.groupBy().agg(F.array_sort(F.collect_list(F.struct("o", "s", "q", "text"))).alias("rows"))
    return numbered.select(F.posexplode("rows").alias("i", "row")).select(
        (F.col("i") + 1).cast("bigint").alias("line_no"), F.col("row.text").alias("text")
    )
