"""What the training-data operators share: landing, hashes, word bytes, task memory, components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.session import new_run_dir, write_table

# Bytes a lookup structure may have and still be sent to every executor.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024

# ASCII upper case to lower case.
LOWER_ASCII = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# The same, and every ASCII byte that is neither digit nor letter becomes a space.
WORD_ASCII = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def land(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: cuts the lineage and survives lost executors."""
    path = new_run_dir(df.sparkSession, label)
    write_table(df, path, partition_by=partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stretches(batch: pa.RecordBatch, text: str, size: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, cut where texts reach ``size`` bytes; a longer text is a stretch of its own."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)) // size
    cuts = [0, *(np.flatnonzero(np.diff(upto)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            yield batch.slice(a, b - a)


def give_back() -> None:
    """Return memory that nothing uses any more from this Python worker to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def freeing(run: Callable[[Iterable], Iterator]) -> Callable[[Iterable], Iterator]:
    """``run`` over a task's batches. Workers outlive tasks: what this one needed is not left to lie beside the next one's."""

    def freed(batches: Iterable) -> Iterator:
        yield from run(batches)
        give_back()

    return freed


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def key_bits(key: Column, bits: int = 60) -> Column:
    """The leading bits of md5 over a key's text as a non-negative long. SQL engines agree on it."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, bits // 4), 16, 10).cast("long")


def crc_of_id(column: str) -> Column:
    """crc32 of an id written as text; null ids have crc32 of the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected edge list (u, v): every node with its component's smallest node.

    Alternates large-star and small-star steps, each linear in the edges, until
    the edges are stars around the smallest node. Each step is landed, so a
    lost executor costs one step.
    """
    edges = edges.select("u", "v").where("u <> v").distinct()
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
        small = down.groupBy("u").agg(F.min("v").alias("m"))
        stars = (
            down.join(small, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        edges = land(stars, "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    # Stars now: every node but the smallest has one edge to it.
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
