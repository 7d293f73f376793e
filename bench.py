"""Headline queries, timed. Prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the tables and the cores; BENCH_ONLY takes
a comma-separated list of query names. Every query runs once untimed on the
same tables, so the times leave out JIT warm-up; then the better of two runs
counts. Each run does the whole work, scratch tables and outputs included.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyline.plans.catalog import QUERIES  # noqa: E402
from tallyline.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "parse_records",
    "parse_malformed",
    "generate_records",
    "sort_by_id",
    "sort_by_name",
    "sort_by_continent",
    "sort_hot_key",
    "sort_hot_record",
    "sort_malformed",
    "sort_fanout",
    "merge_runs",
    "sorted_files_roundtrip",
    "ordered_topic_sink",
    "carry_on_roundtrip",
    "kafka_rows_roundtrip",
    "line_numbers",
    "sort_in_two_steps",
    "stream_source",
    "stream_fanout",
    "route_by_topic",
    "batch_stats",
    "sample_tables",
    "sample_report",
    "count_check",
    "order_check",
    "order_check_unsorted",
)


def run(spark, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    spark = build_session(
        "bench",
        master=f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n] or HEADLINE
    times = {}
    for name in names:
        run(spark, name)
        times[name] = round(min(run(spark, name) for _ in range(2)), 3)
    spark.stop()
    sf = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}
        )
    )


if __name__ == "__main__":
    main()
