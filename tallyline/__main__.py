"""Command line: ``python -m tallyline generate|process|validate|verify``."""

from __future__ import annotations

import argparse
import json
import logging
import re
import time

from tallyline.plans import run
from tallyline.session import build_session
from tallyline.sinks.text import output_paths
from tallyline.sources.topics import FileTopics, KafkaTopics
from tallyline.streaming.drain import FLUSH_INTERVAL, INGEST_IDLE, OUTPUT_IDLE

_UNITS = {"ms": 0.001, "s": 1.0, "m": 60.0, "h": 3600.0}


def duration(text: str) -> float:
    """Seconds from '40s', '1m30s', '500ms' or a plain number."""
    parts = re.findall(r"([\d.]+)(ms|s|m|h)", text)
    if parts and "".join(n + u for n, u in parts) == text:
        return sum(float(n) * _UNITS[u] for n, u in parts)
    return float(text)


def parser() -> argparse.ArgumentParser:
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("-debug", "--debug", action="store_true", help="enable debug logging")
    common.add_argument("-topics", "--topics", help="folder that holds the topics as files; Kafka if not given")
    common.add_argument("-topic-partitions", "--topic-partitions", type=int, default=64, help="partitions the sorted Kafka topics have")
    common.add_argument("-master", "--master", help="Spark master, if spark-submit does not set it")

    top = argparse.ArgumentParser(prog="tallyline")
    programs = top.add_subparsers(dest="program", required=True)

    p = programs.add_parser("generate", parents=[common], help="fill the source topic with random records")
    p.add_argument("-max", "--max", type=int, default=run.DEFAULT_RECORDS, help="records to generate")
    p.add_argument("-workers", "--workers", type=int, help="tasks to generate them in; by default as many as the cluster has cores, or more for many records")
    p.add_argument("-seed", "--seed", type=int, default=None, help="same seed, same records; the clock by default")

    p = programs.add_parser("process", parents=[common], help="sort the source topic into one topic per key")
    p.add_argument("-batch", "--batch", type=int, default=run.DEFAULT_BATCH_BYTES, help="bytes per micro-batch")
    p.add_argument("-max", "--max", type=int, default=run.DEFAULT_RECORDS, help="records to stop at")
    p.add_argument("-timeout", "--timeout", type=duration, default=INGEST_IDLE, help="idle time to stop after")
    p.add_argument("-flush", "--flush", type=duration, default=FLUSH_INTERVAL, help="time between micro-batches")
    p.add_argument("-available-now", "--available-now", action="store_true", help="take what is there and stop")
    p.add_argument("-run-dir", "--run-dir", help="folder of an earlier run to carry on from; a new one by default")

    p = programs.add_parser("validate", parents=[common], help="write the sorted topics to files and report on them")
    p.add_argument("-out", "--out", default="csv", help="folder that gets a folder of outputs for each run")
    p.add_argument("-report", "--report", default="results/SUCCESS.txt", help="path of the report")
    p.add_argument("-timeout", "--timeout", type=duration, default=OUTPUT_IDLE, help="idle time to stop after")
    p.add_argument("-available-now", "--available-now", action="store_true", help="take what is there and stop")
    p.add_argument("-run", "--run", help="run to validate, as process names it; the last complete one by default")
    p.add_argument("-run-dir", "--run-dir", help="folder of an earlier validation to carry on from; a new one by default")

    p = programs.add_parser("verify", parents=[common], help="count the lines of the outputs and check their order")
    p.add_argument("-out", "--out", required=True, help="folder of one validation's outputs")
    p.add_argument("-max", "--max", type=int, default=run.DEFAULT_RECORDS, help="records each output should have")
    return top


def main(argv: list[str] | None = None) -> dict:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.DEBUG if args.debug else logging.INFO)
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = build_session(f"tallyline-{args.program}", args.master)
    topics = FileTopics(args.topics) if args.topics else KafkaTopics(topic_partitions=args.topic_partitions)
    if args.program == "generate":
        seed = time.time_ns() if args.seed is None else args.seed
        result = run.generate(spark, topics, args.max, seed, args.workers)
    elif args.program == "process":
        result = run.process(
            spark,
            topics,
            expected=args.max,
            idle_timeout=args.timeout,
            flush_interval=args.flush,
            batch_bytes=args.batch,
            available_now=args.available_now,
            run_dir=args.run_dir,
        )
    elif args.program == "verify":
        verdict = run.verify(spark, output_paths(args.out), args.max)
        result = {
            "counts": [r.asDict() for r in verdict.counts.collect()],
            "order": [r.asDict() for r in verdict.order.collect()],
        }
    else:
        out_dir = f"{args.out}/{time.time_ns()}"
        written = run.validate(
            spark,
            topics,
            out_dir,
            run_dir=args.run_dir,
            idle_timeout=args.timeout,
            available_now=args.available_now,
            report_path=args.report,
            run=args.run,
        )
        result = {"out_dir": out_dir, "written": written, "report": args.report}
    print(json.dumps(result))
    return result


if __name__ == "__main__":
    main()
