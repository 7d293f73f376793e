from __future__ import annotations

import random

import pytest

from tallyline.operators.checks import count_check, count_per_output, order_check
from tallyline.operators.sampling import report_lines, sample_report, sample_tables
from tallyline.session import new_run_dir
from tallyline.sinks.text import output_paths, write_report


def write_files(folder, lines, parts):
    folder.mkdir(parents=True)
    size = -(-len(lines) // parts) or 1
    for i in range(parts):
        chunk = lines[i * size : (i + 1) * size]
        (folder / f"part-{i:05d}-x-c000.txt").write_text("".join(line + "\n" for line in chunk))
    return str(folder)


def record(i: int) -> str:
    return f"{i},n{i:06d},some address,Asia"


@pytest.mark.parametrize("split_bytes", ["134217728", "4000", "100"])
def test_order_check_finds_the_first_violation(spark, tmp_path, split_bytes):
    clean = [record(i) for i in range(1000)]
    swapped = [*clean[:700], clean[701], clean[700], *clean[702:]]
    reversed_ = clean[::-1]
    outputs = {
        "clean": write_files(tmp_path / "a", clean, 4),
        "swapped": write_files(tmp_path / "b", swapped, 4),
        "boundary": write_files(tmp_path / "c", [*clean[500:], *clean[:500]], 2),
        "reversed": write_files(tmp_path / "d", reversed_, 3),
        "missing": str(tmp_path / "none"),
        "one": write_files(tmp_path / "e", [record(1)], 1),
        "equal": write_files(tmp_path / "f", [record(1)] * 50, 3),
    }
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        for key in ("id", "name"):
            got = order_check(spark, outputs, dict.fromkeys(outputs, key)).collect()
            assert {r.output: tuple(r)[1:] for r in got} == {
                "clean": (1000, 0, None),
                "swapped": (1000, 1, 702),
                "boundary": (1000, 1, 501),
                "reversed": (1000, 999, 2),
                "missing": (0, 0, None),
                "one": (1, 0, None),
                "equal": (50, 0, None),
            }
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_order_check_against_brute_force(spark, tmp_path):
    rng = random.Random(4)
    lines = [record(rng.randrange(10_000)) for _ in range(30_000)]
    keys = [int(line.split(",")[0]) for line in lines]
    falls = [i + 1 for i in range(1, len(keys)) if keys[i] < keys[i - 1]]
    path = write_files(tmp_path / "a", lines, 7)
    row = order_check(spark, {"x": path}, {"x": "id"}).first()
    assert (row.lines, row.violations, row.first_violation) == (30_000, len(falls), falls[0])


def test_ids_are_compared_as_numbers(spark, tmp_path):
    path = write_files(tmp_path / "a", [record(i) for i in (9, 10, 100)], 1)
    assert order_check(spark, {"id": path}).first().violations == 0


def test_counts(spark, tmp_path):
    outputs = {"a": write_files(tmp_path / "a", [record(i) for i in range(7)], 3), "b": str(tmp_path / "none")}
    counts = count_per_output(spark, outputs)
    assert {tuple(r) for r in counts.collect()} == {("a", 7), ("b", 0)}
    assert {tuple(r) for r in count_check(counts, 7).collect()} == {("a", 7, 7, True), ("b", 7, 0, False)}


def expected_samples(lines):
    n = len(lines)
    numbered = list(enumerate(lines, start=1))
    return {
        "head": numbered[:3],
        "mid": [(i, line) for i, line in numbered if n // 2 <= i <= n // 2 + 2],
        "tail": numbered[-3:],
    }


@pytest.mark.parametrize("parts", [1, 3])
def test_samples_of_every_small_size(spark, tmp_path, parts):
    sizes = [*range(0, 9), 40, 1001]
    lines = {f"n{n}": [record(i) for i in range(n)] for n in sizes}
    outputs = {name: write_files(tmp_path / name, rows, parts) for name, rows in lines.items()}
    got: dict = {}
    for row in sample_report(spark, outputs).collect():
        got.setdefault(row.output, {}).setdefault(row.section, []).append((row.seq, row.line_no, row.line))
    for name, rows in lines.items():
        assert got[name].pop("total") == [(1, len(rows), None)]
        found = {section: [v[1:] for v in sorted(values)] for section, values in got[name].items()}
        assert found == {k: v for k, v in expected_samples(rows).items() if v}
        assert all([v[0] for v in sorted(values)] == list(range(1, len(values) + 1)) for values in got[name].values())


def test_samples_of_tables(spark):
    paths, lines = {}, {}
    for n in (0, 1, 2, 5, 500):
        paths[f"n{n}"] = new_run_dir(spark, "table")
        lines[f"n{n}"] = [record(i) for i in range(n)]
        df = spark.createDataFrame([(r,) for r in lines[f"n{n}"]], "raw string").coalesce(1)
        df.write.option("maxRecordsPerFile", 100).parquet(paths[f"n{n}"])
    got: dict = {}
    for row in sample_tables(spark, paths).where("section <> 'total'").collect():
        got.setdefault(row.output, {}).setdefault(row.section, []).append((row.line_no, row.line))
    for name, rows in lines.items():
        want = {k: v for k, v in expected_samples(rows).items() if v}
        assert {k: sorted(v) for k, v in got.get(name, {}).items()} == want


def test_report_text(spark, tmp_path):
    root = str(tmp_path)
    for name in ("id", "name", "continent"):
        write_files(tmp_path / f"{name}_sorted", [record(i) for i in range(4)], 2)
    outputs = output_paths(root)
    report = report_lines(sample_report(spark, outputs), outputs)
    target = f"{root}/results/SUCCESS.txt"
    write_report(report, target)
    write_report(report, target)
    text = [r.value for r in spark.read.text(target).collect()]
    p = outputs["id"]
    assert text[:15] == [
        f"start sampling path={p}",
        f"=== head section === path={p}",
        *[f"[head] path={p} line={record(i)}" for i in (0, 1, 2)],
        f"total lines path={p} total_lines=4",
        f"=== mid section === path={p}",
        *[f"[mid] path={p} line={record(i)}" for i in (1, 2, 3)],
        f"=== tail section === path={p}",
        *[f"[tail] path={p} line={record(i)}" for i in (1, 2, 3)],
        f"start sampling path={outputs['name']}",
    ]
    assert len(text) == 3 * 14
