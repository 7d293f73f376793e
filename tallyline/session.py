"""Session set-up, scratch space and size checks shared by every module."""

from __future__ import annotations

import math
import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

MIB = 1024 * 1024

# A sort partition is sized on bytes scanned. Small ones sort faster, as their
# rows stay in cache: 16 MiB read is some 50 MiB of rows.
TARGET_PARTITION_BYTES = 16 * MIB
# One shuffle makes at most so many. Spark places boundaries by a sample of at
# most a million rows, so this leaves 30 for each partition, and the shuffle has
# a block for every pair of input and output. What needs more is sorted in two
# steps. A cluster that can take more blocks sets its own bound in the session.
MAX_SORT_PARTITIONS = 32_768
MAX_SORT_PARTITIONS_KEY = "tallyline.sort.maxPartitions"
# A task of the first of two steps takes a range of so many bytes scanned, or more
# where there would be more ranges than MAX_SORT_PARTITIONS.
COARSE_RANGE_BYTES = 4 * TARGET_PARTITION_BYTES
# Below this a further partition costs more in scheduling than it saves.
MIN_PARTITION_BYTES = MIB // 4

# Rows a lookup table may have and still be sent to every executor. The tables
# checked against it hold one short row per file or split (about 150 bytes).
MAX_BROADCAST_ROWS = 1_000_000


def build_session(app_name: str = "tallyline", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # Only inputs of more than this for every core are cut this large; it
        # keeps the number of shuffle blocks down where there are most.
        "spark.sql.files.maxPartitionBytes": "512m",
        # A stream that has caught up lists its source once a second, not every 10 ms.
        "spark.sql.streaming.pollingDelay": "1s",
    }
    settings.update(conf)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


# Scratch folders of local sessions that name none, by application.
_LOCAL_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for tables that cut lineage: the one the cluster names.

    A local session that names none gets a folder of this machine, which all of
    its tasks share.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _LOCAL_ROOTS.setdefault(spark.sparkContext.applicationId, f"{tempfile.gettempdir()}/tallyline-{uuid.uuid4().hex}")


# Scratch paths of the step at hand, if it removes them; threads of the step share the list.
_SCOPE: ContextVar[list[str] | None] = ContextVar("tallyline-scratch", default=None)


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A path nothing has written to yet; every run gets its own."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    if (scope := _SCOPE.get()) is not None:
        scope.append(path)
    return path


@contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[None]:
    """What is put into scratch space inside is removed at the end, for steps whose results lie elsewhere by then."""
    own: list[str] = []
    token = _SCOPE.set(own)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for path in own:
            hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


# A write into folders by value sorts a task's rows by those values first, unless
# the task may keep a file open for each. Rows of more values than this are sorted.
OPEN_FILES = 8
OPEN_FILES_KEY = "spark.sql.maxConcurrentOutputFileWriters"
# Writes under way by session, as threads share one, and what a session had set before them.
_WRITES: Counter[str] = Counter()
_SET_BEFORE: dict[str, str | None] = {}
_WRITES_LOCK = threading.Lock()


@contextmanager
def folders_unsorted(spark: SparkSession) -> Iterator[None]:
    """Writes into few folders inside stream a task's rows into open files. A session's own bound stays."""
    session = spark._jsparkSession.sessionUUID()
    with _WRITES_LOCK:
        if not _WRITES[session]:
            _SET_BEFORE[session] = spark.conf.get(OPEN_FILES_KEY, None)
            if _SET_BEFORE[session] is None:
                spark.conf.set(OPEN_FILES_KEY, str(OPEN_FILES))
        _WRITES[session] += 1
    try:
        yield
    finally:
        with _WRITES_LOCK:
            _WRITES[session] -= 1
            if not _WRITES[session]:
                del _WRITES[session]
                if _SET_BEFORE.pop(session) is None:
                    spark.conf.unset(OPEN_FILES_KEY)


def write_table(df: DataFrame, path: str, mode: str = "error", partition_by: Sequence[str] = ()) -> None:
    """Write scratch Parquet. Records are read back several times and zstd makes them a quarter smaller than snappy."""
    writer = df.write.mode(mode).option("compression", "zstd")
    if not partition_by:
        writer.parquet(path)
        return
    with folders_unsorted(df.sparkSession):
        writer.partitionBy(*partition_by).parquet(path)


# Plan leaves that give a task the same rows in the same order every time.
_STEADY_LEAVES = frozenset(("FileSourceScanExec", "BatchScanExec", "LocalTableScanExec", "RangeExec", "EmptyRelationExec"))


def _is_narrow(plan) -> bool:
    """Whether a physical plan reads files and tables without a shuffle on the way. A broadcast side has no order to keep."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return _is_narrow(plan.executedPlan())
    if kind == "BroadcastExchangeExec":
        return True
    children = plan.children()
    if not children.size():
        return kind in _STEADY_LEAVES
    return kind != "ShuffleExchangeExec" and all(_is_narrow(children.apply(i)) for i in range(children.size()))


def repeatable(df: DataFrame) -> DataFrame:
    """``df``, written out first unless it is a file scan with narrow steps.

    Those give a task the same rows in the same order every time, and their
    size is known. What comes out of a shuffle, or from an RDD, may arrive in
    any order and in any amount.
    """
    if _is_narrow(df._jdf.queryExecution().executedPlan()):
        return df
    path = new_run_dir(df.sparkSession, "landed")
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scan_bytes(df: DataFrame) -> int | None:
    """Bytes of the files the plan's scans read, all columns and rows of them, or None if unknown."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    total = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return total if total < 2**60 else None


def max_sort_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get(MAX_SORT_PARTITIONS_KEY, str(MAX_SORT_PARTITIONS)))


def wanted_partitions(df: DataFrame) -> int:
    """How many range partitions of the size that sorts best the rows of ``df`` make."""
    spark = df.sparkSession
    size = scan_bytes(df)
    if size is None:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    cores = spark.sparkContext.defaultParallelism
    return max(1, math.ceil(size / TARGET_PARTITION_BYTES), min(cores, math.ceil(size / MIN_PARTITION_BYTES)))


def coarse_partitions(df: DataFrame) -> int:
    """How many ranges the first of two steps makes: the bound, or more if a range would be too large for a task."""
    size = scan_bytes(df) or 0
    return max(max_sort_partitions(df.sparkSession), min(MAX_SORT_PARTITIONS, math.ceil(size / COARSE_RANGE_BYTES)))


def sort_partitions(df: DataFrame) -> int:
    """How many range partitions one shuffle of ``df`` makes."""
    return min(wanted_partitions(df), max_sort_partitions(df.sparkSession))


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
