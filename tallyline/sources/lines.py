"""Line files as record sources: one record per '\\n'-terminated line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.records import strip_line_end

LINES_SCHEMA = "file_path string, block_start long, line string"


def _hadoop(spark: SparkSession, path: str) -> tuple:
    """The file system of a path, and the path, as Spark sees them."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    store, hadoop_path = _hadoop(spark, path)
    return store.exists(hadoop_path)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system's name, for tasks that open files themselves."""
    store, hadoop_path = _hadoop(spark, path)
    return store.makeQualified(hadoop_path).toString()


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder; 0 if there is none."""
    store, hadoop_path = _hadoop(spark, path)
    return store.getContentSummary(hadoop_path).getLength() if store.exists(hadoop_path) else 0


def make_folder(spark: SparkSession, path: str) -> None:
    store, hadoop_path = _hadoop(spark, path)
    store.mkdirs(hadoop_path)


def touch(spark: SparkSession, path: str) -> None:
    store, hadoop_path = _hadoop(spark, path)
    store.create(hadoop_path).close()


def file_sizes(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names and bytes of what a folder holds; none if there is no such folder."""
    if not path_exists(spark, path):
        return []
    store, hadoop_path = _hadoop(spark, path)
    return sorted((status.getPath().getName(), status.getLen()) for status in store.listStatus(hadoop_path))


def folder_names(spark: SparkSession, path: str) -> list[str]:
    return [name for name, _ in file_sizes(spark, path)]


def delete_files(spark: SparkSession, path: str, names: Sequence[str]) -> None:
    for name in names:
        store, hadoop_path = _hadoop(spark, f"{path}/{name}")
        store.delete(hadoop_path, False)


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Lines of files or directories with the file split each one came from.

    Sub-directories are skipped and a missing path has no lines. Only '\\n'
    ends a line, so a bare carriage return stays inside its record.
    """
    present = [path for path in paths if path_exists(spark, path)]
    if not present:
        return spark.createDataFrame([], LINES_SCHEMA)
    return spark.read.text(present, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("value").alias("line"),
    )


def line_files(spark: SparkSession, *paths: str) -> DataFrame:
    """(file, file_path) of the files ``read_lines`` reads, file being a hash of the path. Reads no file."""
    present = [path for path in paths if path_exists(spark, path)]
    if not present:
        return spark.createDataFrame([], "file long, file_path string")
    path = F.col("_metadata.file_path")
    return spark.read.format("binaryFile").load(present).select(F.xxhash64(path).alias("file"), path.alias("file_path"))


def scan_records(spark: SparkSession, *paths: str) -> DataFrame:
    return read_lines(spark, *paths).select(strip_line_end(F.col("line")).alias("raw"))


FILE_ORDER = ["range_no", "part_no", "chunk_no", "file_path"]


def with_file_order(files: DataFrame) -> DataFrame:
    """Add what, with ``file_path``, puts the part files of one write job in output order.

    Part numbers are compared as numbers: past 99,999 their names no longer
    sort as text. Files with other names come first, by path. A sort in two
    steps has a folder for each stretch of ranges, which counts first.
    """
    name = F.substring_index("file_path", "/", -1)
    return files.withColumns(
        {
            "range_no": F.regexp_extract("file_path", r"/range-(\d+)/[^/]*$", 1).try_cast("bigint"),
            "part_no": F.regexp_extract(name, r"^part-(\d+)-", 1).try_cast("bigint"),
            "chunk_no": F.regexp_extract(name, r"-c(\d+)\.", 1).try_cast("bigint"),
        }
    )
