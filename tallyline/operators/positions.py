"""Line numbers over ordered files, without an ordered pass over all rows.

Rows of one file (or file split) stay in file order, so a line number is the
position inside its file plus the number of rows in the files before it. Only
the table of files, one short row each, is ever put in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.session import MAX_BROADCAST_ROWS, MIB, scan_bytes
from tallyline.sources.lines import FILE_ORDER, with_file_order

_ROW_IN_PARTITION = (1 << 33) - 1  # low bits of monotonically_increasing_id


def running_offsets(counts: DataFrame, *split: str, within: Sequence[str] = ()) -> DataFrame:
    """Add ``offset``, the sum of ``rows`` over the files before this one.

    ``counts`` has one short row per file, or per file split if ``split``
    names what tells the splits of a file apart. 100 TB in splits of 128 MiB
    make 800,000 rows, which one task orders in a second or two.
    """
    before = Window.partitionBy(*within).orderBy(*FILE_ORDER, *split).rowsBetween(Window.unboundedPreceding, -1)
    return with_file_order(counts).withColumn("offset", F.coalesce(F.sum("rows").over(before), F.lit(0)))


def _small_side(df: DataFrame, at_most: int) -> DataFrame:
    return F.broadcast(df) if at_most <= MAX_BROADCAST_ROWS else df


def table_rows(table: DataFrame) -> DataFrame:
    """Rows per file of a Parquet table; read from the footers alone."""
    return table.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count(F.lit(1)).alias("rows"))


def with_line_numbers(table: DataFrame) -> DataFrame:
    """Number the rows of a Parquet table that one job wrote in order."""
    offsets = running_offsets(table_rows(table)).select("file_path", "offset")
    files = len(table._jdf.inputFiles())
    placed = table.select("*", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.row_index").alias("row"))
    return placed.join(_small_side(offsets, files), "file_path").select(
        (F.col("offset") + F.col("row") + 1).alias("line_no"), *table.columns
    )


def split_bound(lines: DataFrame) -> int:
    """An upper bound on the number of splits Spark cuts the line files into."""
    spark: SparkSession = lines.sparkSession
    size = scan_bytes(lines)
    if size is None:
        return MAX_BROADCAST_ROWS + 1
    widest = spark.conf.get("spark.sql.files.maxPartitionBytes")
    widest_bytes = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(widest))
    return len(lines._jdf.inputFiles()) + size // max(widest_bytes, MIB) + spark.sparkContext.defaultParallelism


def number_lines(lines: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Number the lines of text files that one job wrote in order.

    ``within=["file_path"]`` starts again at 1 in every file.

    The files are scanned twice, once to count. Should the second scan cut or
    pack its splits in another way, as it may for small inputs on a cluster that
    grows between them, the query fails rather than number a line wrongly;
    spark.sql.files.minPartitionNum, set by the session's owner, rules that out.
    """
    position = F.monotonically_increasing_id()
    placed = lines.select(
        "*",
        F.spark_partition_id().alias("task"),
        position.bitwiseAND(F.lit(_ROW_IN_PARTITION)).alias("row"),
    )
    split = ["file_path", "block_start", "task"]
    counted = placed.groupBy(*split).agg(F.count(F.lit(1)).alias("rows"), F.min("row").alias("first_row"))
    offsets = running_offsets(counted, "block_start", within=within)
    in_split = F.col("row") - F.col("first_row")
    same_split = F.coalesce((in_split >= 0) & (in_split < F.col("rows")), F.lit(False))
    line_no = F.when(same_split, F.col("offset") + in_split + 1).otherwise(
        F.raise_error(F.lit("line files were split in two different ways; run the query again")).cast("bigint")
    )
    return placed.join(_small_side(offsets, split_bound(lines)), split, "left").select(
        line_no.alias("line_no"), *lines.columns
    )
