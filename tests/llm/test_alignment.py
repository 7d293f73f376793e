from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyline.llm import alignment, queries

A, B = (public_tokenizers.path(x) for x in (queries.BYTE_LEVEL, queries.PIECES))
SMALL = "/root/testdata/sf0.001"


def brute(texts):
    """Per text: n_a, n_b, n_groups, n_links, n_best, count_sum, groups; and the counts of all pairs. By walking both sequences."""
    a_model, b_model = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_model.encode_special_tokens = True
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    rows, pairs = [], Counter()
    for text in texts:
        whole = (" " + (text or "")).encode()
        a = a_model.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_model.encode(text) if text else []
        a_bytes = [bytes(letters[c] for c in a_model.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [b_model.id_to_piece(i)]]
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            rows.append(([], [], [], []))
            continue
        groups, links, i, j = [], [], 0, 0
        while i < len(a):
            s, t = i, j
            x, y = len(a_bytes[i]), len(b_bytes[j])
            while x != y:
                if x < y:
                    i += 1
                    x += len(a_bytes[i])
                else:
                    j += 1
                    y += len(b_bytes[j])
            links.append((a[i], b[j]))
            i, j = i + 1, j + 1
            groups.append(",".join(map(str, a[s:i])) + "|" + ",".join(map(str, b[t:j])))
        rows.append((a, b, groups, links))
        pairs.update(links)
    best = Counter()
    for (_, y), n in pairs.items():
        best[y] = max(best[y], n)
    out = [(len(a), len(b), len(g), len(x), sum(pairs[p] == best[p[1]] for p in x), sum(pairs[p] for p in x), ";".join(g)) for a, b, g, x in rows]
    return out, pairs


def hard_texts():
    rng = random.Random(5)
    odd = ["", None, " ", "a", "  two  spaces ", "\n\t x\r\n", "a▁b", "\x00\x7f", "<|endoftext|> <s> </s> <unk> <0x41>", "é é ﬁ ½", "日本語。", "🙂👍🏽", "I'll DON'T 'S 12345", "x" * 20000, " " * 3000 + "y", "ß​　z"]
    letters = "abcdefgh  \n.,'éß日🙂́"
    return odd + ["".join(rng.choices(letters, k=rng.randrange(80))) for _ in range(300)] + ["the same text again"] * 70


@pytest.mark.parametrize("room, fan_in, segment", [(64 << 20, 64, 1 << 16), (17 * 60, 2, 16)])
def test_matches_brute_force(spark, documents, monkeypatch, room, fan_in, segment):
    """Also with a small bound, which takes many slices of the hash, and a deep tree of small segments."""
    monkeypatch.setattr(alignment, "MAX_BROADCAST_BYTES", room)
    monkeypatch.setattr(alignment, "FAN_IN", fan_in)
    monkeypatch.setattr(alignment, "SEGMENT", segment)
    texts = hard_texts() if room > 10000 else hard_texts()[:90]
    want, pairs = brute(texts)
    found = alignment.align(documents(texts, extra="pairs"), A, B)
    assert room > 10000 or len(found.slices) > 2
    got = {r["id"]: tuple(r)[1:] for r in found.documents().collect()}
    assert got == dict(enumerate(want))
    assert {(r["a"], r["b"]): r["n"] for r in found.table(spark).collect()} == pairs


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want, _ = brute([r["text"] for r in docs])
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.alignment_query(spark, SMALL).collect()}
    assert len(got) == len(docs)
    for r, (*numbers, groups) in zip(docs, want):
        assert got[r["doc_id"]] == (*numbers, hashlib.sha256(groups.encode()).hexdigest() if groups else "")


def test_null_and_repeated_ids_and_empty_table(spark, documents):
    rows = [(None, "some words"), (1, "some words"), (1, "some words"), (2, None)]
    (want, nothing), _ = brute(["some words", None]), None
    want, nothing = brute(["some words"] * 3 + [None])[0][0], (0, 0, 0, 0, 0, 0, "")
    got = sorted((tuple(r) for r in alignment.align(documents(rows), A, B).documents().collect()), key=str)
    assert got == sorted([(None, *want), (1, *want), (1, *want), (2, *nothing)], key=str)
    assert alignment.align(documents([]), A, B).documents().collect() == []
    assert alignment.align(documents([None, ""]), A, B).table(spark).collect() == []


@given(st.sets(st.integers(0, 2**33), max_size=300), st.sets(st.integers(0, 2**33), max_size=20))
def test_hash_is_minimal_perfect_and_verified(keys, others):
    pairs = np.array(sorted(keys), dtype=np.int64)
    shards = []
    for shard in np.unique(alignment._shard_of(pairs)):
        sizes, bits, order = alignment.build_hash(pairs[alignment._shard_of(pairs) == shard])
        shards.append((int(shard), sizes, bits.tobytes(), order.tobytes()))
    index = alignment.PairIndex(shards)
    found = index.find(pairs)
    assert sorted(found) == list(range(len(pairs))) and index.keys[found].tolist() == pairs.tolist()
    for other in others - keys:
        try:
            assert index.find(np.array([other])).tolist() == [-1]
        except ValueError:
            assert index.own[alignment._shard_of(np.array([other]))[0]]


def test_equal_keys_are_refused():
    with pytest.raises(ValueError, match="distinct"):
        alignment.build_hash(np.array([7, 7]))
