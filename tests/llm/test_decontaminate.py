from __future__ import annotations

import os
import random
import re
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tallyline.llm import decontaminate

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
# MB of a process that has freed what a task held, all but every thousandth piece: without and with giving back.
HUNGRY = """
from tallyline.llm.common import freeing
def hungry(batches):
    held = [bytes(5000) for _ in range(40_000)]
    batches.extend(held[::1000])
    yield 0
def used():
    return int(open("/proc/self/statm").read().split()[1]) * 4096 >> 20
kept = []
list(hungry(kept))
before = used()
list(freeing(hungry)(kept))
print(before, used())
"""
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, items, window=10):
    out = []
    for text in texts:
        w, hit, found = words(text), set(), set()
        for item, body in items:
            b = words(body)
            n = min(window, len(b))
            grams = {tuple(b[i : i + n]) for i in range(len(b) - n + 1)} if n else set()
            for i in range(len(w) - n + 1 if n else 0):
                if tuple(w[i : i + n]) in grams:
                    hit |= set(range(i, i + n))
                    found.add(item)
        out.append((len(w), sorted(hit), found - {None}))
    return out


def fixture():
    rng = random.Random(5)
    vocabulary = ["Alpha", "beta", "gamma", "d1", "épée", "z"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([3, 9, 10, 14])))) for i in range(12)]
    items += [(90, None), (91, ""), (92, "..."), (0, items[0][1]), (None, "null item words only here and nowhere else at all today")]
    texts = [" ".join(rng.choices(vocabulary, k=rng.choice([2, 30, 80]))) for _ in range(25)]
    texts += [items[3][1].upper() + "! " + items[4][1], "x " + items[1][1].replace(" ", "\n--"), None, "", "!!", items[-1][1]]
    texts += [" ".join(rng.choices(vocabulary, k=4000))]
    return texts, items


@pytest.mark.parametrize("max_bytes", [1 << 26, 1 << 13])
def test_matches_brute_force_also_in_slices(spark, documents, max_bytes):
    texts, items = fixture()
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.find_hits(documents(texts, extra="hit"), bench, max_bytes=max_bytes).orderBy("doc_id").collect()
    got = [
        (r["n_words"], sorted({p for s in r["hit_spans"] for p in range(s["first"], s["last"] + 1)}), set(r["hit_items"])) for r in rows
    ]
    assert got == brute(texts, items)
    assert {r["hit"] for r in rows} == {"kept aside"}


@pytest.mark.parametrize("max_bytes", [1 << 26, 1 << 11])
def test_removal_leaves_nothing_and_spares_clean_texts(spark, documents, max_bytes):
    passage = "one two three four five six seven eight nine ten eleven"
    nested = "one two three four five " + passage + " six seven eight nine ten eleven"
    long = " ".join(f"own{i}" for i in range(40))
    texts = [f"{long} {passage.upper()}, {long}", f"{long} {nested} {long}", long, passage, None, ""]
    bench = spark.createDataFrame([(1, passage), (2, "other words " * 8)], "item_id long, text string")
    kept = {r["doc_id"]: r["text"] for r in decontaminate.remove(documents(texts), bench, max_bytes=max_bytes).collect()}
    assert kept[2] == long and kept[4] is None and kept[5] == ""
    assert 3 not in kept
    assert words(kept[0]) == words(long + " " + long) == words(kept[1])
    assert decontaminate.find_hits(documents([kept[0], kept[1]]), bench).where(F.size("hit_spans") > 0).count() == 0


@pytest.mark.parametrize("kind", ["tinyint", "int", "bigint", "string", "date", "decimal(9,2)"])
@pytest.mark.parametrize("max_bytes", [1 << 26, 1 << 9])
def test_item_ids_of_any_type_and_names_in_any_case(spark, documents, kind, max_bytes):
    rows = [("1", "one two three"), ("2", "four five six"), ("3", "one two three"), (None, "seven eight")]
    cast = F.date_add(F.lit("2020-01-01").cast("date"), F.col("item_id").cast("int")) if kind == "date" else F.col("item_id").cast(kind)
    bench = spark.createDataFrame(rows, "item_id string, text string").withColumn("item_id", cast)
    docs = documents(["a one two three four", "seven eight", None], extra="N_WORDS").withColumn("Hit_Items", F.lit(1))
    found = decontaminate.find_hits(docs, bench, max_bytes=max_bytes)
    assert found.schema["hit_items"].dataType.elementType == bench.schema["item_id"].dataType
    got = found.select("doc_id", "n_words", "hit_items").orderBy("doc_id").collect()
    ids = {r["item_id"] for r in bench.where("text = 'one two three'").collect()}
    assert [(r["n_words"], set(r["hit_items"])) for r in got] == [(5, ids), (2, set()), (0, set())]


def test_empty_tables(spark, documents):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert [r["hit_spans"] for r in decontaminate.find_hits(documents(["a b"]), empty).collect()] == [[]]
    assert decontaminate.find_hits(documents([]), empty).collect() == []


@pytest.mark.parametrize("max_bytes", [1 << 26, 1 << 11])
def test_share_counts_the_hits_of_all_slices(spark, documents, max_bytes):
    items = [(k, " ".join(f"item{k}x{j}" for j in range(10))) for k in range(12)]
    own = " ".join(f"own{j}" for j in range(40))
    # 60 of 100 words in six items; 30 of 70; an item around an item, which only shows after a cut.
    most = " ".join([own, *(t for _, t in items[:6])])
    some = " ".join([own, *(t for _, t in items[6:9])])
    head, tail = items[9][1].split()[:5], items[9][1].split()[5:]
    around = " ".join([own, *head, items[10][1], *tail])
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = documents([most, some, around, own, None], extra="hit_spans")
    got = decontaminate.remove(docs, bench, max_bytes=max_bytes)
    assert got.columns == docs.columns
    rows = {r["doc_id"]: r for r in got.collect()}
    assert sorted(rows) == [1, 2, 3, 4]
    assert words(rows[1]["text"]) == words(rows[2]["text"]) == words(own) and rows[3]["text"] == own and rows[4]["text"] is None
    assert {r["hit_spans"] for r in rows.values()} == {"kept aside"}


def test_a_batch_is_scanned_in_small_pieces(spark, monkeypatch):
    """A worker takes the words of a few texts of a batch at a time; results are those of whole batches."""
    passage = " ".join(f"p{k}" for k in range(12))
    own = lambda k: " ".join(f"w{k}x{j}" for j in range(30))
    rows = [(k, None if k % 7 == 0 else own(k) if k % 3 else f"{own(k)} {passage} {own(k + 1)}") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame([("a", passage)], "item_id string, text string")
    removed = lambda: sorted(tuple(r) for r in decontaminate.remove(docs, items).collect())
    hits = lambda: sorted((r["doc_id"], r["n_words"], str(r["hit_spans"]), str(r["hit_items"])) for r in decontaminate.find_hits(docs, items).collect())
    whole = removed(), hits()
    assert len(whole[0]) == 300 and not any(passage in (t or "") for _, t in whole[0])
    scan = decontaminate._scan_texts

    def small(index, texts):
        assert sum(len((t or "").encode()) for t in texts) < 2 * 4096
        return scan(index, texts)

    monkeypatch.setattr(decontaminate, "TEXT_BYTES", 4096)
    monkeypatch.setattr(decontaminate, "_scan_texts", small)
    assert (removed(), hits()) == whole


def test_a_worker_gives_memory_back():
    """What a task needed and freed does not stay with the worker."""
    left = subprocess.run([sys.executable, "-c", HUNGRY], capture_output=True, text=True, timeout=60, cwd=ROOT)
    kept, freed = map(int, left.stdout.split())
    assert freed < kept - 50, left
