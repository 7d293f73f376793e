from __future__ import annotations

import random
import re
import string
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import types as T

from tallyline.llm import divergence

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("lang", "source", "text", "term", "by")])


def brute(rows, least_docs=3, top=200):
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(LOWER))) for lang, source, text, *_ in rows]
    out = set()
    for lang in {x for x, _, _ in docs}:
        seen = Counter(t for x, _, w in docs if x == lang for t in set(w))
        kept = sorted(t for t, n in seen.items() if n >= least_docs)
        sources = sorted({s for x, s, _ in docs if x == lang})
        counts = {s: Counter(t for x, y, w in docs if (x, y) == (lang, s) for t in w if t in set(kept)) for s in sources}
        counts[None] = sum(counts.values(), Counter())
        p = {s: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept} for s, c in counts.items()}
        f = lambda a, b, t: (p[a][t] - p[b][t]) ** 2 // p[b][t]  # noqa: B023, E731
        for s in sources:
            parts = {
                "pair": [(-sum(f(s, o, t) for t in kept), o.encode()) for o in sources if o != s],
                "term": [(-f(s, None, t), t.encode()) for t in kept if counts[s][t] and p[s][t] > p[None][t]],
            }
            for part, found in parts.items():
                for rank, (value, item) in enumerate(sorted(found)[: None if part == "pair" else top], 1):
                    out.add((lang, s, part, item.decode(), -value, rank))
    return out


def audited(spark, rows, **more):
    got = divergence.audit(spark.createDataFrame([tuple([*r, None, "x"][:5]) for r in rows], SCHEMA), **more)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    return [tuple(r) for r in got.collect()]


@pytest.mark.parametrize("held", [3, 1_000_000])
def test_matches_brute_force(spark, monkeypatch, held):
    monkeypatch.setattr(divergence, "HELD_TERMS", held)
    monkeypatch.setattr(divergence, "HELD_COUNTS", held)
    rng = random.Random(held)
    words = [rng.choice(["", "é", "ß", "日", "Z"]) + w for w in ("the", "The", "of", "x", "long" * 30, "naïve", "a")] + [f"w{chr(97 + k % 26)}{'ab'[k % 2] * (k // 26)}" for k in range(80)]
    rows = [
        (rng.choice(["en", "en", "de", None, ""]), rng.choice(["a", "b", "c", "é", "", None]), " ".join(rng.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=rng.randrange(60))))
        for _ in range(150)
    ]
    # A hot group, repeated rows, a language without a vocabulary, a group without terms.
    rows += [("en", "hot", "the the, of! 12 x9y")] * 60
    rows += [("fr", s, t) for s, t in (("a", "un"), ("b", "deux"), ("c", None))] + [("en", "blank", " 12 .")] + [("it", "only", "uno " * 5000)] * 3
    got = audited(spark, rows)
    assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_least_docs_and_top(spark):
    rows = [("en", s, t) for s, t in (("a", "x y z"), ("a", "x x y"), ("b", "y q"), ("b", "z z z q"))]
    assert set(audited(spark, rows, least_docs=2, top=1)) == brute(rows, 2, 1)


def test_empty_table(spark):
    assert audited(spark, []) == []
    assert set(audited(spark, [("en", "a", None), ("en", "b", "")])) == {("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)}


def test_too_many_groups_are_refused(spark, monkeypatch):
    monkeypatch.setattr(divergence, "MAX_BROADCAST_BYTES", 100)
    with pytest.raises(ValueError, match="groups"):
        audited(spark, [("en", "a", "x")])


@given(st.lists(st.integers(0, 3), max_size=60))
def test_run_lengths(column):
    x = np.array(column, dtype=np.int64)
    at = np.flatnonzero(x)
    starts, values = divergence.run_lengths(at, x[at], len(x))
    assert np.repeat(values, np.diff(np.append(starts, max(len(x), 1))))[: len(x)].tolist() == column
    assert all(values[1:] != values[:-1]) and starts[0] == 0


@given(st.integers(0, 10**15), st.integers(0, 10**15), st.integers(1, 10**9))
def test_shares_are_exact(count, more, terms):
    total = count + more
    assert divergence._shares(np.array([count]), total, terms)[0] == 1 + 10**9 * (count + 1) // (total + terms)


def test_shares_in_sql(spark):
    rng = random.Random(1)
    rows = [(c := rng.randrange(10 ** rng.randrange(1, 15)), c + rng.randrange(10 ** rng.randrange(1, 15)), rng.randrange(1, 10**9)) for _ in range(300)]
    frame = spark.createDataFrame(rows, "c long, n long, v long")
    got = frame.select("c", "n", "v", divergence.share(frame["c"], frame["n"], frame["v"]).alias("p")).collect()
    assert all(r["p"] == 1 + 10**9 * (r["c"] + 1) // (r["n"] + r["v"]) for r in got)
