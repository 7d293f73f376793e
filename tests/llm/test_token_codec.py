from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyline.llm import token_codec as codec
from tallyline.llm.queries import TOKENIZER

PATH = public_tokenizers.path(TOKENIZER)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 99), max_size=1500), st.integers(0, 5))
def test_round_trip(ids, docs):
    ids = np.array(ids, dtype=np.int64)
    lengths = np.bincount(np.arange(len(ids)) % max(docs, 1), minlength=docs) if docs else np.empty(0, dtype=np.int64)
    names = [None if i == 2 else i * 7 - 3 for i in range(docs)]
    got = codec.decode_block(codec.encode_block(names, lengths, ids, 100))
    assert got[0] == names and (got[1] == lengths).all() and (got[2] == ids).all()


@pytest.mark.parametrize("kind", ["same", "cycle", "uniform", "edges"])
def test_round_trip_of_large_blocks(kind):
    rng = np.random.default_rng(1)
    n, v = 300_000, 49_408
    ids = {
        "same": np.full(n, 7),
        "cycle": np.arange(n) % 1000,
        "uniform": rng.integers(0, v, n),
        "edges": rng.choice([0, v - 1], n, p=[0.999, 0.001]),
    }[kind]
    block = codec.encode_block([1], np.array([n]), ids, v)
    assert (codec.decode_block(block)[2] == ids).all()
    bits = {"same": 0.5, "cycle": 0.6, "uniform": 18, "edges": 0.6}[kind]
    assert 8 * len(block) / n < bits


def test_context_beats_order_zero():
    rng = np.random.default_rng(2)
    follow = rng.integers(0, 5000, (5000, 2))
    ids, x = [], 0
    for k in (rng.random(200_000) < 0.1).astype(int):
        x = follow[x, k]
        ids.append(x)
    # A follower nine times in ten; by frequency alone an id costs over twelve bits.
    assert 8 * len(codec.encode_block([1], np.array([len(ids)]), np.array(ids), 5000)) / len(ids) < 4


def test_damage_is_noticed():
    block = bytearray(codec.encode_block([1], np.array([5000]), np.arange(5000) % 17, 100))
    block[len(block) // 2] ^= 1
    with pytest.raises(ValueError):
        codec.decode_block(bytes(block))


def test_texts_by_word_equal_whole_texts():
    tokenizer = Tokenizer.from_file(PATH)
    texts = ["Hello  World's 12th\n\nday ", "a\tb\x0bc\x1cd e f", "<|endoftext|> x<|startoftext|>y", "İΣΑΣ ς́ é ́a ﬁ", "", None, "émouvant$$$ " * 3000]
    ids, lengths = codec.WordIds(PATH, 2).encode(texts)
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    assert lengths.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_hostile_texts_equal_whole_texts(monkeypatch):
    monkeypatch.setattr(codec, "CACHE_RUNS", 500)
    tokenizer, words = Tokenizer.from_file(PATH), codec.WordIds(PATH, 2)
    rng = np.random.default_rng(3)
    odd = [0x300, 0x301, 0x327, 0x345, 0x3A3, 0x3C2, 0x130, 0x1E9E, 0xFB01, 0x4E2D, 0xAC00, 0x1100, 0x1161, 0x1F600, 0x1F1E9, 0x200D, 0xFEFF, 0xFFFD, 0xFFFF, 0x10FFFF, 0xD7FF, 0xE000]
    chars = [chr(c) for c in [*range(0, 0x250), *range(0x2000, 0x2070), *odd]]
    plain = list("abcdefgzABCZéÉßœŒÿŸ" * 40 + "0123456789'.,<>|\n  " * 30)
    added = ["<|endoftext|>", "<|startoftext|>", "<|end", "'ll", "'S"]
    pool = chars + plain + added * 5
    for _ in range(20):
        texts = ["".join(pool[i] for i in rng.integers(0, len(pool), rng.integers(0, 60))) for _ in range(150)]
        ids, lengths = words.encode(texts)
        want = [tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts]
        assert lengths.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]
    assert words.older


def test_stretches_hold_all_rows(monkeypatch):
    monkeypatch.setattr(codec, "TEXT_BYTES", 10)
    texts = ["", None, "x" * 35, "ab", "cdefghijk", None, "é" * 9, ""]
    batch = codec.pa.RecordBatch.from_pydict({"text": codec.pa.array(texts, codec.pa.string())})
    got = [b.column("text").to_pylist() for b in codec._stretches(batch)]
    assert [t for part in got for t in part] == texts and len(got) > 2
    assert list(codec._stretches(batch.slice(0, 0))) == []


def test_files_hold_documents_in_order(spark, documents, tmp_path):
    texts = [(5, "five five"), (None, "no id"), (3, None), (-2, ""), (3, "again a three"), (5, "five five"), (9, "long " * 5000)]
    path = str(tmp_path / "tokens")
    codec.write_tokens(documents(texts * 3, extra="start"), path, PATH)
    rows = codec.read_tokens(spark, path, with_ids=True).orderBy("start").collect()
    ids = [r["doc_id"] for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0)) and len(ids) == 21
    tokenizer = Tokenizer.from_file(PATH)
    at = 0
    for r in rows:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) and r["ids"][-1] == 2
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes())
        at += r["n_tokens"]
    want = sorted((i is not None, i or 0, str(tokenizer.encode(t or "", add_special_tokens=False).ids + [2])) for i, t in texts * 3)
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, str(r["ids"])) for r in rows) == want


def test_empty_table(spark, documents, tmp_path):
    path = str(tmp_path / "none")
    codec.write_tokens(documents([]), path, PATH)
    assert codec.read_tokens(spark, path).collect() == []
