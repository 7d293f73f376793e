from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyline.llm import mixing

DIMS = ("source", "lang")


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n long, probability string")


def shares(rows, dim):
    all_tokens = sum(r["n"] * r["probability"] for r in rows)
    out = {}
    for r in rows:
        out[r[dim] or ""] = out.get(r[dim] or "", 0) + r["n"] * r["probability"] / all_tokens
    return out


def test_expected_shares_are_the_targets(spark):
    rows = [(i, ("a", "b", None)[min(i % 7, 2)], ("x", "y")[i % 2], 1 + i % 5, "old") for i in range(3000)]
    targets = {
        "source": spark.createDataFrame([("a", 0.5), ("b", 0.3), ("", 0.2)], "source string, share double"),
        "lang": spark.createDataFrame([("x", 0.7), ("y", 0.3)], "lang string, share double"),
    }
    got = mixing.sample_to_targets(table(spark, rows), DIMS, F.col("n"), targets=targets).collect()
    assert len(got) == 3000
    assert shares(got, "source") == pytest.approx({"a": 0.5, "b": 0.3, "": 0.2}, rel=1e-4)
    assert shares(got, "lang") == pytest.approx({"x": 0.7, "y": 0.3}, rel=1e-4)
    assert max(r["probability"] for r in got) == pytest.approx(1.0)
    expected = sum(r["probability"] for r in got)
    assert abs(sum(r["kept"] for r in got) - expected) < 5 * expected**0.5


def test_tempered_shares_lift_the_small(spark):
    rows = [(i, "big" if i % 10 else "small", "x", 10, "") for i in range(1000)]
    got = shares(mixing.sample_to_targets(table(spark, rows), DIMS, F.col("n"), alpha=0.5).collect(), "source")
    assert got == pytest.approx({"big": 0.75, "small": 0.25}, rel=1e-4)


def test_repeats_nulls_and_empty(spark):
    rows = [(7, "a", "x", 3, "")] * 4 + [(None, None, None, 0, ""), (8, "a", None, 2, "")]
    got = mixing.sample_to_targets(table(spark, rows), DIMS, F.col("n")).collect()
    assert len(got) == 6 and len({r["kept"] for r in got if r["doc_id"] == 7}) == 1
    assert mixing.sample_to_targets(table(spark, []), DIMS, F.col("n")).collect() == []


@pytest.mark.parametrize("share", [None, 0.0, -1.0])
def test_categories_without_a_share_are_kept_out_but_not_lost(spark, share):
    rows = [(i, ("a", "b", None)[i % 3], ("x", "y")[i // 3 % 2], 1 + i % 5, "old") for i in range(600)] + [(900, "b", "only b", 4, "")]
    given = [("a", 0.25), (None, 0.25), ("no documents", 0.5)] + ([("b", share)] if share is not None else [])
    targets = {"source": spark.createDataFrame(given, "source string, share double")}
    got = mixing.sample_to_targets(table(spark, rows), DIMS, F.col("n"), alpha=1.0, targets=targets).collect()
    assert len(got) == len(rows)
    assert all(r["probability"] == 0 and not r["kept"] for r in got if r["source"] == "b")
    assert shares(got, "source") == pytest.approx({"a": 0.5, "": 0.5, "b": 0.0}, rel=1e-4)
    rest = [r for r in got if r["source"] != "b"]
    tokens = {y: sum(r["n"] for r in rest if r["lang"] == y) / sum(r["n"] for r in rest) for y in "xy"}
    assert shares(rest, "lang") == pytest.approx(tokens, rel=1e-4)


def test_nothing_has_a_share(spark):
    targets = {"source": spark.createDataFrame([("other", 1.0)], "source string, share double")}
    got = mixing.sample_to_targets(table(spark, [(1, "a", "x", 3, ""), (2, None, "y", 0, "")]), DIMS, F.col("n"), targets=targets).collect()
    assert [(r["probability"], r["kept"]) for r in got] == [(0.0, False)] * 2


def test_targets_that_contradict_are_reported(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_CYCLES", 3)
    # Each source has one language, so both marginals cannot hold.
    rows = [(i, "ab"[i % 2], "xy"[i % 2], 1, "") for i in range(10)]
    targets = {
        "source": spark.createDataFrame([("a", 0.9), ("b", 0.1)], "source string, share double"),
        "lang": spark.createDataFrame([("x", 0.5), ("y", 0.5)], "lang string, share double"),
    }
    with pytest.warns(UserWarning, match="targets not reached"):
        assert len(mixing.sample_to_targets(table(spark, rows), DIMS, F.col("n"), targets=targets).collect()) == 10


def test_token_count(spark):
    df = spark.createDataFrame([(None,), ("",), (" a  b\n\tc ",), ("a\u00a0b",)], "t string")
    assert [r[0] for r in df.select(mixing.token_count(F.col("t"))).collect()] == [0, 0, 3, 1]
