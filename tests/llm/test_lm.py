from __future__ import annotations

import math
import random
import re
import string
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyline.llm import common, lm

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=300), st.integers(0, 3))
def test_elias_fano(values, stretch):
    values = np.sort(np.array(values, dtype=np.int64)) * 10**stretch
    bound = 5001 * 10**stretch
    ef = lm.EliasFano.build(values, bound)
    assert (ef.access(np.arange(len(values))) == values).all()
    x = np.unique(np.concatenate([values, np.arange(0, bound, max(1, bound // 97))]))
    i, same = ef.successor(x)
    assert (i == np.searchsorted(values, x)).all()
    assert (same == np.isin(x, values)).all()


@pytest.mark.parametrize("repeats", [1, 3])
def test_long_buckets_are_not_walked(monkeypatch, repeats):
    # One bucket holds all but the last value, as that of a frequent follower does.
    values = np.append(np.repeat(np.arange(0, 8192, 2), repeats), 1 << 32)
    ef = lm.EliasFano.build(values, (1 << 32) + 1)
    reads, low = [], lm.EliasFano._low
    monkeypatch.setattr(lm.EliasFano, "_low", lambda self, i: reads.append(len(i)) or low(self, i))
    x = np.append(np.arange(8200), 1 << 32)
    i, same = ef.successor(x)
    assert (i == np.searchsorted(values, x)).all()
    assert (same == np.isin(x, values)).all()
    assert sum(reads) <= 16 * len(x)


def test_trie_on_disk(tmp_path):
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 900, 20_000) << lm.ID_BITS | rng.integers(0, 50_000, 20_000))
    value = -rng.random(len(keys)) * 8
    lm.NgramTrie.build(keys, value).save(str(tmp_path))
    trie = lm.NgramTrie.open(str(tmp_path))
    assert np.abs(trie.log10(keys) - value).max() <= 0.5 / lm.QUANT
    other = np.setdiff1d(rng.integers(0, 1 << 30, 5000), keys)
    assert np.isnan(trie.log10(other)).all()
    in_memory = trie.mapped()
    assert (in_memory.log10(keys) == trie.log10(keys)).all() and np.isnan(in_memory.log10(other)).all()
    assert np.isnan(lm.NgramTrie.build(keys[:0], value[:0]).mapped().log10(keys)).all()


def peak_bytes(run):
    tracemalloc.start()
    try:
        return run(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_trie_is_built_and_asked_in_steps():
    # One follower is in many steps, most are in one with others; some keys are not there.
    rng = np.random.default_rng(5)
    keys = np.unique(np.append(rng.integers(0, 900, 400_000), np.full(200_000, 7)) << lm.ID_BITS | rng.integers(0, 1 << lm.ID_BITS, 600_000))
    value = -rng.random(len(keys)) * 8
    trie, built = peak_bytes(lambda: lm.NgramTrie.build(keys[::2], value[::2]))
    got, asked = peak_bytes(lambda: trie.log10(keys))
    assert np.abs(got[::2] - value[::2]).max() <= 0.5 / lm.QUANT and np.isnan(got[1::2]).all()
    assert built <= 5 * keys[::2].nbytes
    assert asked <= 4 * keys.nbytes


@pytest.mark.parametrize("step", [1, 3, 64])
def test_steps_do_not_show(monkeypatch, step):
    monkeypatch.setattr(lm, "STEP", step)
    rng = np.random.default_rng(step)
    keys = np.unique(rng.integers(0, 9, 300) << lm.ID_BITS | rng.integers(0, 5000, 300))
    value = -rng.random(len(keys)) * 8
    trie = lm.NgramTrie.build(keys, value)
    assert (trie.contexts.access(np.arange(len(keys))) & ((1 << lm.ID_BITS) - 1) == keys & ((1 << lm.ID_BITS) - 1)).all()
    assert np.abs(trie.log10(keys) - value).max() <= 0.5 / lm.QUANT
    assert np.isnan(trie.log10(np.setdiff1d(np.arange(10) << lm.ID_BITS, keys))).all()


class Captured:
    """Stands for a DataFrame: gives what its tasks would run."""

    def select(self, *_):
        return self

    repartitionById = select

    def mapInArrow(self, run, _):
        return run


def test_a_shard_is_scored_in_little_memory_and_workers_give_theirs_back(monkeypatch):
    monkeypatch.setattr(lm, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    rng = np.random.default_rng(6)
    words = np.array([f"w{i}" for i in range(20_000)])
    docs = [" ".join(rng.choice(words[: 40 if i % 2 else None], 300)) for i in range(1500)]
    met = Counter(w for d in docs for w in lm.tokens_of(d))
    cached = [w for w, _ in met.most_common(5000)] + [lm.END]
    known = lm.Vocabulary(cached, [met[w] or len(docs) for w in cached], met.total() + len(docs), len(met) + 1)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(docs))), pa.array([True] * len(docs)), pa.array(docs)], names=["id", "train", "text"])
    code = lm._code(Captured(), SimpleNamespace(value=(known, np.zeros(len(cached) + 1, dtype=bool))), 1, False)
    coded = pa.Table.from_batches(code(iter([batch])))
    assert len(given) == 1
    pairs = coded.filter(pa.compute.equal(coded["kind"], "pairs"))
    shard = lm._score_pairs(Captured(), SimpleNamespace(value=(known.counts, known.unigram, known.total + known.distinct + 1)), 1, 3.0)
    made, peak = peak_bytes(lambda: list(shard(iter(pairs.to_batches()))))
    assert len(given) == 2
    at, sums = (np.concatenate([np.array(v) for b in made for v in b.column(c).to_pylist()]) for c in ("at", "sums"))
    assert sorted(set(at.tolist())) == list(range(len(docs)))
    assert peak <= 110 * sum(pairs["n"].to_pylist())
    tokens = [[lm.END, *lm.tokens_of(d), lm.END] for d in docs]
    c, of = Counter(p for t in tokens for p in zip(t, t[1:])), met + Counter({lm.END: len(docs)})
    mass = known.total + known.distinct + 1
    for d in (0, 1, 1499):
        want = sum(math.log10((c[h, w] + 3.0 * (of[w] + 1) / mass) / (of[w] + 3.0)) for h, w in zip(tokens[d], tokens[d][1:]))
        assert sums[at == d].sum() == pytest.approx(want, abs=301 / lm.QUANT)


def brute(rows, held, size, smoothing):
    tokens = [WORD.findall((t or "").translate(LOWER)) + [" "] for _, t in rows]
    counts, pairs = Counter(), Counter()
    for w, h in zip(tokens, held):
        if not h:
            counts.update(w)
    total, distinct = sum(counts.values()), len(counts)
    steps = sorted({1, *(n + 1 for n in counts.values())})
    least = next(c for c in steps if sum(n >= c for n in counts.values()) <= size)
    head = {w: c for w, c in counts.items() if c >= least}
    head.setdefault(" ", counts[" "])
    rare = total - sum(head.values())
    mass = rare + distinct - sum(c > 0 for c in head.values()) + 1
    kind = lambda w: w if w in head else None
    for w, h in zip(tokens, held):
        if not h:
            pairs.update(zip(map(kind, [" ", *w]), map(kind, w)))
    first = lambda k: (mass if k is None else head[k] + 1) / (total + distinct + 1)
    out = []
    for w in tokens:
        base = sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in w)
        score = 0.0
        for h, x in zip([" ", *w], w):
            h, k = kind(h), kind(x)
            score += math.log10((pairs[h, k] + smoothing * first(k)) / ((rare if h is None else head[h]) + smoothing))
            score += math.log10((counts[x] + 1) / mass) if k is None else 0
        out.append((len(w), sum(counts[x] > 0 for x in w), total, base, score))
    return out


@pytest.mark.parametrize("size", [10_000, 7, 1])
def test_matches_brute_force(spark, documents, monkeypatch, size):
    monkeypatch.setattr(lm, "BATCH_WORDS", 300)
    monkeypatch.setattr(lm, "COUNT_WORDS", 20)
    rng = random.Random(size)
    words = ["the"] * 30 + [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choices(words, k=rng.choice([0, 1, 8, 90])))) for i in range(60)]
    rows += [(100, None), (None, "The null id"), (101, "unknown1 unknown2"), (101, "unknown1 unknown2"), (102, "the " * 2000)]
    held = [i is not None and i % 5 in (1, 2) for i, _ in rows]
    frame = documents(rows, extra="score")
    got = lm.score(frame, (F.col("doc_id") % 5).isin(1, 2), size=size, smoothing=3.0).collect()
    key = lambda r: (str(r[0]), r[1], r[2], round(r[4], 6))
    want = sorted(((i, *b[:3], b[3], b[4], h) for (i, _), b, h in zip(rows, brute(rows, held, size, 3.0), held)), key=key)
    have = sorted(((r["id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"], r["held_out"]) for r in got), key=key)
    assert len(have) == len(want)
    for a, b in zip(have, want):
        assert a[:4] == b[:4] and a[6] == b[6]
        assert a[4] == pytest.approx(b[4], rel=1e-9)
        assert a[5] == pytest.approx(b[5], abs=a[1] / lm.QUANT)


def test_probabilities_of_followers_add_up():
    known = lm.Vocabulary([b"a", b"b", lm.END], [5, 3, 4], 20, 9)
    assert known.unigram.sum() == pytest.approx(1.0)
    again = known.__reduce__()
    copy = again[0](*again[1])
    assert copy.ids == known.ids and (copy.counts == known.counts).all() and copy.rare_mass == known.rare_mass


def test_no_training_documents_and_empty_table(spark, documents):
    got = lm.score(documents(["a b", None]), F.lit(True)).orderBy("id").collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got] == [(3, 0, 0, 0.0), (1, 0, 0, 0.0)]
    assert all(math.isfinite(r["score"]) for r in got)
    assert lm.score(documents([]), F.lit(False)).collect() == []


@pytest.mark.parametrize("held_pairs", [1, 900, lm.HELD_PAIRS])
def test_no_tokens_are_merged_beyond_the_cache(spark, documents, monkeypatch, held_pairs):
    monkeypatch.setattr(lm, "HELD_PAIRS", held_pairs)
    monkeypatch.setattr(lm, "EMIT_BYTES", 2000)
    monkeypatch.setattr(lm, "CACHED", 5)
    monkeypatch.setattr(lm, "BATCH_WORDS", 300)
    monkeypatch.setattr(lm, "SHARD_PAIRS", 50)
    rng = random.Random(8)
    words = ["the"] * 60 + [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(rng.choices(words, k=rng.choice([0, 1, 8, 90])))) for i in range(60)]
    rows += [(100, None), (101, "unknown1 unknown2 " * 400), (103, "w1 w2 " * 200), (102, "the " * 2000)]
    held = [i % 5 in (1, 2) for i, _ in rows]
    got = {r["id"]: r for r in lm.score(documents(rows), (F.col("doc_id") % 5).isin(1, 2), smoothing=3.0).collect()}
    assert len(got) == len(rows)
    for (i, _), b in zip(rows, brute(rows, held, 10_000, 3.0)):
        assert (got[i]["n_tokens"], got[i]["n_known"], got[i]["train_tokens"]) == b[:3]
        assert got[i]["base_score"] == pytest.approx(b[3], rel=1e-9)
        assert got[i]["score"] == pytest.approx(b[4], abs=b[0] / lm.QUANT)


def test_more_tokens_than_are_cached(spark, documents):
    once = [f"t{i}" for i in range(lm.CACHED + 20_000)]
    rows = [(5 * i, " ".join(once[at : at + 10_000])) for i, at in enumerate(range(0, len(once), 10_000))]
    rows += [(1, "t7 t8 t9"), (2, "t9 t7 t8"), (6, "t8 unknown")]
    held = [i % 5 in (1, 2) for i, _ in rows]
    got = {r["id"]: r["score"] for r in lm.score(documents(rows), (F.col("doc_id") % 5).isin(1, 2)).collect()}
    counts, pairs = Counter(), Counter()
    texts = {i: [" ", *t.split(), " "] for i, t in rows}
    for i, h in zip(texts, held):
        if not h:
            counts.update(texts[i][1:])
            pairs.update(zip(texts[i], texts[i][1:]))
    all_mass = sum(counts.values()) + len(counts) + 1
    assert got.keys() == texts.keys()
    for i, w in texts.items():
        want = sum(
            math.log10((pairs[h, x] + lm.SMOOTHING * (counts[x] + 1) / all_mass) / (counts[h] + lm.SMOOTHING)) for h, x in zip(w, w[1:])
        )
        assert got[i] == pytest.approx(want, abs=len(w) / lm.QUANT)
