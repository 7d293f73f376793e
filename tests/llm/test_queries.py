"""The queries that SQL cannot express, over whole tables, against brute force."""

from __future__ import annotations

import html
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyline.llm import lm, queries

from .test_ann import brute as brute_neighbours
from .test_lm import brute as brute_lm

SMALL = "/root/testdata/sf0.001"


def test_names():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(queries.oracles()) <= set(queries.QUERIES)


def test_nearest_neighbours(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = {}
    for r in queries.ann_query(spark, SMALL).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = brute_neighbours(rows, [i for i, _ in rows if i % 50 == 0])
    assert set(got) == set(want)
    assert sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want) >= 0.9 * 5 * len(want)
    exact = {q: dict(brute_neighbours(rows, [q], len(rows))[q]) for q in list(want)[:3]}
    for q, scores in exact.items():
        assert all(s == pytest.approx(scores[v], abs=1e-11) for v, s in got[q])


def test_tokens(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want, at = set(), 0
    for doc_id, text in sorted(docs):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        want.add((doc_id, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    assert {tuple(r) for r in queries.token_query(spark, SMALL).select("doc_id", "start", "n_tokens", "ids_crc32").collect()} == want


def test_page_texts(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    rows = queries.html_query(spark, SMALL).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r["page_id"]], re.DOTALL)[1]
        blocks = re.split(r"</?(?:p|h1)>", article)
        clean = [" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "<br" in b else "", b)).split()) for b in blocks]
        assert r["text"] == "\n\n".join(b for b in clean if b) and r["n_chars"] == len(r["text"])


def test_toxicity_on_held_out_labels(spark, sf_dir):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = queries.toxicity_query(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    known = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(p == y for p, y in known) >= 0.95 * len(known)
    assert sum(p and y for p, y in known) >= 0.75 * sum(y for _, y in known)


def test_language_model(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs]
    want = {i: (*b, h) for (i, _), b, h in zip(docs, brute_lm(docs, held, 10**9, lm.SMOOTHING), held)}
    rows = queries.lm_query(spark, SMALL).collect()
    assert len(rows) == len(docs)
    base = score = 0.0
    for r in rows:
        n, known, total, b, s, h = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (n, known, total, h)
        assert r["base_score"] == pytest.approx(b, rel=1e-9)
        assert r["score"] == pytest.approx(s, abs=n / lm.QUANT)
        if h:
            base, score = base + b, score + s
    assert score > base
