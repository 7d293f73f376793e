"""Scratch space, with and without a folder named by the cluster."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
from pyspark.sql import DataFrameWriter

from tallyline import session
from tallyline.operators import sorting
from tallyline.plans import run
from tallyline.sources.lines import path_exists
from tallyline.sources.topics import FileTopics

PLAIN = """
from tallyline.session import build_session, new_run_dir, scratch_root, write_table
spark = build_session("plain", master="local[1]")
assert spark.conf.get("spark.checkpoint.dir", None) is None
path = new_run_dir(spark, "x")
write_table(spark.range(3), path)
assert spark.read.parquet(path).count() == 3
assert scratch_root(spark) == scratch_root(spark) and path.startswith(scratch_root(spark))
print("fine")
"""


def test_a_plain_installation_has_scratch_space(tmp_path):
    """No configuration folder at all, so nothing names a checkpoint folder."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": root, "TMPDIR": str(tmp_path)}
    done = subprocess.run([sys.executable, "-c", PLAIN], env=env, capture_output=True, text=True, timeout=180)
    assert done.stdout.strip().endswith("fine"), done.stderr[-2000:]


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_a_cluster_has_to_name_a_folder(master):
    class Named:
        class conf:
            get = staticmethod(lambda name, default=None: default)

        class sparkContext:
            applicationId = "app"

    Named.sparkContext.master = master
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(Named)


def test_scratch_of_a_step_is_removed(spark):
    """Also what its threads made, and nothing else."""
    kept = session.new_run_dir(spark, "kept")
    session.write_table(spark.range(2), kept)
    made = []

    def job(key, by):
        path = session.new_run_dir(spark, key)
        session.write_table(spark.range(2), path)
        made.append(path)

    with session.scratch_removed(spark):
        sorting.for_each_key(spark, {"a": (), "b": ()}, job)
        assert all(path_exists(spark, p) for p in made)
    assert not any(path_exists(spark, p) for p in made) and path_exists(spark, kept)
    with pytest.raises(KeyError), session.scratch_removed(spark):
        job("c", ())
        raise KeyError
    assert not path_exists(spark, made[-1])
    job("d", ())
    assert path_exists(spark, made[-1])


def test_programs_leave_no_scratch(spark, tmp_path, monkeypatch):
    """The landed records of a run stay, for a later run to carry on; all else goes."""
    made, real = [], session.new_run_dir
    for module in (session, sorting, run):
        monkeypatch.setattr(module, "new_run_dir", lambda spark, label: made.append(real(spark, label)) or made[-1])
    monkeypatch.setattr(session, "MAX_SORT_PARTITIONS", 2)
    monkeypatch.setattr(session, "TARGET_PARTITION_BYTES", 8192)
    topics = FileTopics(f"{tmp_path}/topics")
    run.generate(spark, topics, 4000, 1, 4)
    first = run.process(spark, topics, available_now=True)
    assert run.validate(spark, topics, f"{tmp_path}/out", idle_timeout=2)["id"] == 4000
    assert len(made) == 5 and [p for p in made if path_exists(spark, p)] == [first["run_dir"]]


def test_folders_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    """Few folders by value: files are kept open, so no task holds its rows to sort them. The session stays as it was."""
    seen = []
    parquet = DataFrameWriter.parquet

    def writing(self, path, *more, **options):
        seen.append(int(spark.conf.get(session.OPEN_FILES_KEY)))
        parquet(self, path, *more, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", writing)
    for values in (3, 3 * session.OPEN_FILES):
        path = str(tmp_path / f"by-{values}")
        session.write_table(spark.range(1000).selectExpr("id", f"cast(id % {values} as string) topic"), path, partition_by=["topic"])
        assert sorted(tuple(r) for r in spark.read.parquet(path).selectExpr("id", "cast(topic as int)").collect()) == [(i, i % values) for i in range(1000)]
    assert len(seen) == 2 and min(seen) > 0
    assert spark.conf.get(session.OPEN_FILES_KEY, None) is None


def test_a_session_keeps_its_own_bound_of_open_files(spark):
    own = spark.newSession()
    own.conf.set(session.OPEN_FILES_KEY, "2")
    with session.folders_unsorted(own), session.folders_unsorted(own):
        assert own.conf.get(session.OPEN_FILES_KEY) == "2"
    assert own.conf.get(session.OPEN_FILES_KEY) == "2"
