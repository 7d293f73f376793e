"""Text outputs: sorted copies, routed topics and the report."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyline.operators.sorting import SORT_KEYS, SortKey, for_each_key, global_sort
from tallyline.session import folders_unsorted, repeatable, sort_partitions
from tallyline.sinks.ordered import write_lines


def output_paths(root: str, names: Sequence[str] = tuple(SORT_KEYS)) -> dict[str, str]:
    return {name: f"{root}/{name}_sorted" for name in names}


def write_sorted_outputs(
    df: DataFrame, root: str, keys: Mapping[str, SortKey] = SORT_KEYS, num_partitions: int | None = None
) -> dict[str, int]:
    """One sorted text output per key under ``root``; returns the lines written for each.

    ``root`` has to be new: nothing already there is overwritten, and an
    output is complete once its _SUCCESS file is there.
    """
    paths = output_paths(root, list(keys))
    df = repeatable(df.select("raw"))
    return for_each_key(
        df.sparkSession, keys, lambda key, by: write_lines(global_sort(df, by, num_partitions), paths[key])
    )


def write_topic_outputs(messages: DataFrame, root: str, topics: Sequence[str]) -> dict[str, int]:
    """One text output per topic, its messages in (partition, offset) order, each of them once.

    The shuffle that restores the order also brings together what came twice.
    """
    paths = output_paths(root, topics)

    def write(topic: str, _) -> int:
        rows = messages.where(F.col("topic") == topic).select(
            "partition", "offset", F.coalesce("value", F.lit("")).alias("raw")
        )
        ordered = rows.repartitionByRange(sort_partitions(rows), "partition", "offset")
        once = ordered.groupBy("partition", "offset").agg(F.first("raw").alias("raw"))
        return write_lines(once.sortWithinPartitions("partition", "offset").select("raw"), paths[topic])

    return for_each_key(messages.sparkSession, dict.fromkeys(topics, ()), write)


def copy_topic_outputs(spark: SparkSession, read: Callable[[str], DataFrame], root: str, topics: Sequence[str]) -> dict[str, int]:
    """One text output per topic, from topics whose files have their messages in order.

    Nothing is moved or sorted: a task writes what it reads, and the manifest
    puts the files in the order of (partition, offset).
    """
    paths = output_paths(root, topics)

    def write(topic: str, _) -> int:
        place = F.col("partition").cast("bigint").alias("part"), F.col("offset").alias("place")
        return write_lines(read(topic).select(*place, F.coalesce("value", F.lit("")).alias("raw")), paths[topic])

    return for_each_key(spark, dict.fromkeys(topics, ()), write)


def route_by_topic(messages: DataFrame, path: str, topics: Sequence[str]) -> dict[str, int]:
    """Append each message to the folder of its topic; unknown topics write nothing.

    Returns the messages routed and rejected. No shuffle: every task writes
    its own file into the folders it has messages for.
    """
    known = F.coalesce(F.col("topic").isin(*topics), F.lit(False))
    seen = Observation()
    with folders_unsorted(messages.sparkSession):
        (
            messages.observe(
                seen, F.count_if(known).alias("routed"), F.count_if(~known).alias("rejected")
            )
            .where(known)
            .select("topic", F.coalesce("value", F.lit("")).alias("value"))
            .write.partitionBy("topic")
            .text(path, lineSep="\n")
        )
    return seen.get


def write_report(lines: DataFrame, path: str) -> None:
    """Replace the report at ``path``. It has a few dozen lines, so it goes into one file."""
    lines.coalesce(1).sortWithinPartitions("line_no").select("text").write.mode("overwrite").text(path, lineSep="\n")
