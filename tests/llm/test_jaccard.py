from __future__ import annotations

import random
import re
import string

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyline.llm import jaccard

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets_of(texts, n):
    out = []
    for t in texts:
        w = WORD.findall((t or "").translate(LOWER))
        out.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    return out


def brute(ids, texts, n, threshold):
    """Smallest id reachable by links, by comparing all pairs."""
    sets, a, b = sets_of(texts, n), *threshold
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        for j in range(i):
            if s and b * len(s & sets[j]) >= a * len(s | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, x in enumerate(ids):
        least[root(i)] = min(x, least.get(root(i), x))
    return {x: (len(sets[i]), least[root(i)]) for i, x in enumerate(ids)}


def near_copies(rng, words, share):
    out = list(words)
    for i in rng.sample(range(len(out)), max(1, int(share * len(out)))):
        out[i] = f"w{rng.randrange(10**6)}"
    return out


@pytest.mark.parametrize("shingle, threshold", [(4, (85, 100)), (5, (80, 100)), (1, (50, 100))])
def test_matches_brute_force(spark, documents, monkeypatch, shingle, threshold):
    rng = random.Random(shingle)
    texts = []
    for _ in range(25):
        base = [f"w{rng.randrange(60)}" for _ in range(rng.choice([5, 9, 30, 200]))]
        texts.append(" ".join(base))
        texts += [" ".join(near_copies(rng, base, share)) for share in (0.005, 0.02, 0.04, 0.1)]
        texts += [" ".join(base).upper(), " ".join(base[:-1]), " ".join(base + ["end"])]
    hub = [f"h{i}" for i in range(150)]
    texts += [" ".join(near_copies(rng, hub, 0.02)) for _ in range(120)]
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [passage + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(80)) for _ in range(20)]
    texts += [None, "", " \n", "a b", "A  b", "a", "x " * 3000]
    ids = rng.sample(range(-1000, 5000), len(texts))
    monkeypatch.setattr(jaccard, "TILE", 40)
    got = jaccard.link(documents(list(zip(ids, texts)), extra="n"), shingle=shingle, threshold=threshold).collect()
    assert {r["id"]: (r["n"], r["component_id"]) for r in got} == brute(ids, texts, shingle, threshold)


def test_without_broadcast_of_copies(spark, documents, monkeypatch):
    monkeypatch.setattr(jaccard, "MAX_BROADCAST_BYTES", 0)
    texts = ["a b c d e f g h"] * 5 + ["a b c d e f g h i j k l m n o p q r s t u v w x y z"] * 2
    texts += ["a b c d e f g h i j k l m n o p q r s t u v w x y z z"]
    got = jaccard.link(documents(texts)).collect()
    assert {r["id"]: r["component_id"] for r in got} == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 5: 5, 6: 5, 7: 5}


@settings(max_examples=150, deadline=None)
@given(st.integers(6, 400), st.integers(0, 2**31), st.sampled_from([(85, 100), (80, 100), (50, 100)]))
def test_linked_sets_always_share_a_signature(size, seed, threshold):
    a, b = threshold
    rng = np.random.default_rng(seed)
    r = rng.integers(0, 2**63, size, dtype=np.uint64)
    # The larger set of a pair at the very threshold.
    extra = rng.integers(0, 2**63, size, dtype=np.uint64)
    drop = int(rng.integers(0, size))
    common = r[drop:]
    grown = 0
    while b * len(common) >= a * (size + grown + 1):
        grown += 1
    s = np.concatenate([common, extra[:grown]])
    if b * len(common) < a * (size + grown) or set(r.tolist()) == set(s.tolist()):
        return
    bands = jaccard.Bands(threshold)
    assert set(jaccard.signatures(r, bands).tolist()) & set(jaccard.signatures(s, bands).tolist())
    maps = jaccard.folded([jaccard.bitmap(np.unique(r)), jaccard.bitmap(np.unique(s))])
    assert np.bitwise_count((maps[0] ^ maps[1]).view(np.uint64)).sum() <= len(set(r.tolist()) ^ set(s.tolist()))


def test_null_and_repeated_ids_and_empty_table(spark, documents):
    rows = [(None, "a b c d e"), (1, "a b c d e"), (1, "a b c d e"), (2, "A b c d e")]
    got = sorted(((r["id"] or -1, r["component_id"]) for r in jaccard.link(documents(rows)).collect()), key=str)
    assert got == [(-1, None), (1, 1), (1, 1), (2, 1)]
    assert jaccard.link(documents([])).collect() == []
