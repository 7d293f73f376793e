"""The pipeline's rows against a brute-force version of its stages, and its rules."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tallyline.llm import mixing, queries, toxicity
from tallyline.session import new_run_dir, write_table
from .test_decontaminate import brute as brute_hits
from .test_decontaminate import words
from .test_jaccard import brute as brute_links

ROW = ("doc_id", "text", "lang", "source", "n_chars")


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """The rows that each stage leaves, documents first."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [(docs.columns, docs.collect())]
    for name, stage in corpus_pipeline.STAGES:
        path = new_run_dir(spark, name)
        write_table(stage(spark, docs, sf_dir), path)
        docs = spark.read.parquet(path)
        out.append((docs.columns, docs.collect()))
    return out


def test_stages_keep_the_columns_of_documents(stages):
    assert [s[0] for s in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "token_output"]
    for columns, rows in stages[:-1]:
        assert tuple(columns) == ROW
        assert rows


def test_toxic_documents_go_and_others_stay(spark, sf_dir, stages):
    before, after = ({r["doc_id"] for r in rows} for _, rows in stages[:2])
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = queries.toxicity_model(spark, sf_dir, docs)
    matcher = model.matcher()
    rejected = {r["doc_id"] for r in stages[0][1] if model.score(*matcher.hits(r["text"])) >= toxicity.THRESHOLD}
    assert rejected and before - after == rejected
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    clean = [i for i in before if labels.get(i) == 0]
    assert len([i for i in clean if i not in after]) <= 0.01 * len(clean)


def test_one_document_of_each_group_stays(stages):
    rows = stages[1][1]
    links = brute_links([r["doc_id"] for r in rows], [r["text"] for r in rows], 5, (80, 100))
    assert {r["doc_id"] for r in stages[2][1]} == {i for i, (_, c) in links.items() if i == c}


def test_benchmark_passages_are_cut(spark, sf_dir, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    before = {r["doc_id"]: r for r in stages[2][1]}
    after = {r["doc_id"]: r for r in stages[3][1]}
    ids = list(before)
    for i, (n, hit, _) in zip(ids, brute_hits([before[i]["text"] for i in ids], items)):
        if not hit:
            assert after[i] == before[i]
        elif len(hit) > 0.5 * n:
            assert i not in after
        else:
            w = words(before[i]["text"])
            left = words(after[i]["text"])
            assert len(left) <= n - len(hit) and set(left) <= set(w)
            assert after[i]["n_chars"] == len(after[i]["text"])
    assert not any(hit for _, hit, _ in brute_hits([r["text"] for r in after.values()], items))


def test_mixing_keeps_documents_by_probability(spark, stages):
    rows = stages[3][1]
    docs = spark.createDataFrame(rows).withColumn("topic", queries.topic_of(F.col("text")))
    chance = {
        r["doc_id"]: r["probability"]
        for r in mixing.sample_to_targets(docs, queries.MIX, mixing.token_count(F.col("text")), queries.MIX_ALPHA).collect()
    }
    uniform = lambda i: int(hashlib.md5(f"{i}:mix".encode()).hexdigest()[:13], 16) / 2**52
    assert {r["doc_id"] for r in stages[4][1]} == {i for i, p in chance.items() if uniform(i) < p}
    assert 0.2 * len(rows) < len(stages[4][1]) < len(rows)


def test_tokens_are_those_of_the_kept_texts(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER))
    at, want = 0, set()
    for r in sorted(stages[4][1], key=lambda r: r["doc_id"]):
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        want.add((r["doc_id"], at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    assert {(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in stages[5][1]} == want


def test_rows_that_share_an_id_and_null_rows(spark, documents, sf_dir):
    text = "some words that stand here for no reason at all but to be the same"
    rows = [(1, text), (1, text), (2, text.upper()), (3, None), (None, text), (None, ""), (4, "")]
    frame = documents(rows, extra="id")
    kept = corpus_pipeline.drop_near_duplicates(spark, frame, sf_dir)
    assert kept.columns == frame.columns
    got = sorted(((r["doc_id"] or 0, r["text"]) for r in kept.collect()), key=str)
    assert got == sorted([(1, text), (3, None), (0, text), (0, ""), (4, "")], key=str)


def test_extra_columns_of_any_name_and_type_pass_through(spark, documents, sf_dir):
    text = "some plain words about the weather and the garden that nobody minds at all"
    frame = documents([(1, text), (1, text), (1, text), (2, "quite another text about boats that sail from one island to the next in summer"), (None, None), (3, "")], extra="Toxicity")
    extra = {"toxic_terms": "1", "kept": "'mine'", "N_Tokens": "map('a', 2)", "probability": "array(map('b', doc_id))", "hit_spans": "struct(map('c', 3) as m)"}
    for name, value in extra.items():
        frame = frame.withColumn(name, F.expr(value))
    before = {r["doc_id"]: r for r in frame.collect()}
    docs = frame
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == frame.columns, name
        assert docs.dtypes == frame.dtypes, name
        path = new_run_dir(spark, name)
        write_table(docs, path)
        docs = spark.read.parquet(path)
        if name == "near_duplicates":
            assert sorted(r["doc_id"] or 0 for r in docs.collect()) == [0, 1, 2, 3]
    rows = docs.collect()
    assert rows and all(r == before[r["doc_id"]] for r in rows)


def test_empty_documents(spark, documents, sf_dir):
    docs = documents([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.collect() == []
