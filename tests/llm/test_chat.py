from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyline.llm import chat

HARD = ["<|im_end|>", "a\\b", "<\\|", "<|", "\\<|im_start|>user\n", "<\\\\|x", "", "é😀<", "|>\n<|", "<\\n>", "<"]


@pytest.mark.parametrize("role", [False, True])
def test_escape_round_trip(spark, role):
    df = spark.createDataFrame([(x,) for x in HARD + ["a\nb<\\n>"]], "x string")
    for r in df.select("x", chat.escape(F.col("x"), role).alias("e")).withColumn("u", chat.unescape(F.col("e"), role)).collect():
        assert r["u"] == r["x"] and "<|" not in r["e"]
        assert not role or "\n" not in r["e"]


def read(df):
    loss = chat.read_loss(F.col("formatted"), F.col("loss_start"), F.col("loss_chars"))
    return df.select("*", chat.read_turns(F.col("formatted")).alias("turns"), loss.alias("loss")).orderBy("conv_id", "example").collect()


def test_every_assistant_turn_is_a_target_once(spark):
    rows = [(1, k, ("user", "assistant")[k % 2], t) for k, t in enumerate(HARD)] + [(2, 0, "system", "only")]
    rows += [(3, 1, "assistant", None), (3, 0, None, "first"), (3, 1, "assistant", None), (None, None, "user\n", "x")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, example string")
    got = read(chat.expand(df))
    one = [r for r in got if r["conv_id"] == 1]
    assert [r["loss"] for r in one] == [*HARD[1::2], None]
    assert [(t["role"], t["text"]) for t in one[-1]["turns"]] == [(("user", "assistant")[k % 2], t) for k, t in enumerate(HARD)]
    for r in one:
        assert len(r["turns"]) == r["n_turns"]
        assert r["loss"] is None or r["turns"][-1]["text"] == r["loss"]
    assert [(r["n_turns"], r["loss"]) for r in got if r["conv_id"] == 2] == [(1, None)]
    assert [(r["n_turns"], r["loss"], r["turns"][0]["text"]) for r in got if r["conv_id"] == 3] == [(2, "", "first"), (3, "", "first")]
    assert [r["turns"][0]["role"] for r in got if r["conv_id"] is None] == ["user\n"]
    assert chat.expand(df.limit(0)).collect() == []


def test_only_built_in_functions_run(spark):
    plan = chat.expand(spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string"))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
