"""Benchmark decontamination by normalised word n-grams.

The n-grams of all test items form one hash set, broadcast after a check of
its size; a benchmark above the bound is cut into slices that fit, one pass
each, and the hits of all are put together before anything is decided on them. Every window of a training text is hashed, a hit is verified word by
word, and hit words are reported, cut out, or their document removed.

A word is a run of digits, letters a to z (A to Z lower-cased) and non-ASCII
characters. An item with fewer words than a window is one window as a whole;
an item without words matches nothing. Null texts have no words. Items of null
id mark words but are not listed. Repeated rows are handled like any other;
empty tables give no hits, or no rows. Columns of documents are kept as they
are, except those called like a result, in any case.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.common import MAX_BROADCAST_BYTES, WORD_ASCII, free_name, freeing, land, stretches

WINDOW = 10
WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
SPANS = "array<struct<first:bigint,last:bigint>>"
#: Words that are scanned at once, and bytes of texts that are held for it beside their batch.
CHUNK_WORDS = 1 << 17
TEXT_BYTES = 1 << 21
# Fixed value: odd 64-bit multiplier of the window hash.
MULTIPLIER = 0x9E3779B97F4A7C15


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_ASCII).split()


class WindowIndex:
    """All windows of some items: hashes, the words to verify them by, and the items they come from."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[int, dict[tuple[int, ...], set]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            n = min(window, len(ids))
            for at in range(len(ids) - n + 1 if n else 0):
                found.setdefault(n, {}).setdefault(tuple(ids[at : at + n]), set()).add(item)
        self.levels = []
        for n, windows in sorted(found.items()):
            ids = np.array(list(windows), dtype=np.int64)
            owners = [sorted((i for i in s if i is not None), key=str) for s in windows.values()]
            multiplier = MULTIPLIER
            while len(np.unique(hashes := _rolling(ids.ravel(), n, multiplier)[::n])) < len(ids):
                multiplier = (multiplier * MULTIPLIER + 2) % 2**64 | 1
            order = np.argsort(hashes)
            self.levels.append((n, multiplier, hashes[order], ids[order], [owners[i] for i in order]))

    def scan(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, list]]:
        """For each window length: (length, start positions, window numbers, items of each window). Id 0 is no item word."""
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        for n, multiplier, hashes, windows, owners in self.levels:
            if len(ids) < n:
                continue
            at = np.flatnonzero(known[n:] - known[:-n] == n)
            if not len(at):
                continue
            mine = _rolling(ids, n, multiplier)[at]
            found = np.minimum(np.searchsorted(hashes, mine), len(hashes) - 1)
            same = hashes[found] == mine
            at, found = at[same], found[same]
            true = (ids[at[:, None] + np.arange(n)] == windows[found]).all(axis=1)
            yield n, at[true], found[true], owners


def _rolling(ids: np.ndarray, n: int, multiplier: int) -> np.ndarray:
    """A hash of each run of ``n`` ids."""
    x = ids.astype(np.uint64)
    x = (x ^ (x >> np.uint64(7))) * np.uint64(0xFF51AFD7ED558CCD) + np.uint64(1)
    out = np.zeros(len(x) - n + 1, dtype=np.uint64)
    for k in range(n):
        out = out * np.uint64(multiplier) + x[k : len(x) - n + 1 + k]
    return out


def _scan_texts(index: WindowIndex, texts: list[str | None]) -> Iterator[tuple[int, list, set]]:
    """For each text: words, runs of hit words (first, last), items."""
    get, begin = index.vocabulary.get, 0
    while begin < len(texts):
        flat: list[int] = []
        starts, counts, end = [], [], begin
        while end < len(texts) and len(flat) < CHUNK_WORDS:
            words = words_of(texts[end])
            starts.append(len(flat))
            counts.append(len(words))
            flat.extend([get(w, 0) for w in words])
            flat.append(0)  # no window crosses it
            end += 1
        ids = np.array(flat, dtype=np.int64)
        edge = np.zeros(len(ids) + 1, dtype=np.int64)
        items: dict[int, set] = {}
        first = np.array(starts)
        for n, at, found, owners in index.scan(ids):
            np.add.at(edge, at, 1)
            np.add.at(edge, at + n, -1)
            for doc, window in set(zip((np.searchsorted(first, at, "right") - 1).tolist(), found.tolist())):
                items.setdefault(doc, set()).update(owners[window])
        hit = np.diff(np.concatenate([[0], np.cumsum(edge) > 0, [0]]).astype(np.int8))
        firsts, lasts = np.flatnonzero(hit == 1), np.flatnonzero(hit == -1) - 1
        runs: dict[int, list] = {}
        for doc, a, b in zip((np.searchsorted(first, firsts, "right") - 1).tolist(), firsts.tolist(), lasts.tolist()):
            runs.setdefault(doc, []).append((a - starts[doc], b - starts[doc]))
        for i, n in enumerate(counts):
            yield n, runs.get(i, []), items.get(i, set())
        begin = end


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _slices(benchmark: DataFrame, item: str, text: str, max_bytes: int) -> list[DataFrame]:
    """The items in groups that may be broadcast; a group is collected when its turn comes."""
    items = benchmark.select(F.col(item).alias("item"), F.col(text).alias("text")).distinct()
    # An index of word ids, hashes and owners takes some 30 times the text.
    size = 30 * (items.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    n = max(1, math.ceil(size / max_bytes))
    if n == 1:
        return [items]
    number = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    return [items.where(number == k) for k in range(n)]


def _index(items: DataFrame, window: int) -> WindowIndex:
    return WindowIndex([tuple(r) for r in items.collect()], window)


def find_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_spans`` (runs of hit words, by word position) and ``hit_items``."""
    kind = benchmark.schema[item].dataType
    kept = [f for f in docs.schema if f.name.lower() not in ("n_words", "hit_spans", "hit_items")]
    schema = T.StructType(
        kept + [T.StructField("n_words", T.LongType()), T.StructField("hit_spans", T._parse_datatype_string(SPANS)), T.StructField("hit_items", T.ArrayType(kind))]
    )
    names, out = [f.name for f in kept], docs.select(*(docs[f.name] for f in kept))
    spans_type = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    items_type = pa.list_(benchmark.select(F.col(item).alias("item")).limit(0).toArrow().schema.field("item").type)
    for k, items in enumerate(_slices(benchmark, item, item_text, max_bytes)):
        if k:
            out = land(out, "decontaminated")
        index = docs.sparkSession.sparkContext.broadcast(_index(items, window))

        def scan(batches, index=index, again=k > 0):
            for batch in (piece for whole in batches for piece in stretches(whole, text, TEXT_BYTES)):
                counts, spans, ids = [], [], []
                for n, runs, found in _scan_texts(index.value, batch.column(text).to_pylist()):
                    counts.append(n)
                    spans.append(runs)
                    ids.append(found)
                if again:
                    old = zip(batch.column("hit_spans").to_pylist(), batch.column("hit_items").to_pylist())
                    for i, (was, had) in enumerate(old):
                        spans[i] = _merge(spans[i] + [(s["first"], s["last"]) for s in was])
                        ids[i] |= set(had)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in names]
                    + [
                        pa.array(counts, pa.int64()),
                        pa.array([[{"first": a, "last": b} for a, b in runs] for runs in spans], spans_type),
                        pa.array([sorted(x, key=str) for x in ids], items_type),
                    ],
                    names=[*names, "n_words", "hit_spans", "hit_items"],
                )

        out = out.mapInArrow(freeing(scan), schema)
    return out


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without its words of these positions, nor what stands between the words of one span."""
    raw = text.encode("utf-8", "surrogatepass")
    at = [m.span() for m in WORDS.finditer(raw.translate(WORD_ASCII))]
    pieces, end = [], 0
    for a, b in spans:
        pieces.append(raw[end : at[a][0]])
        end = at[b][1]
    return b"".join([*pieces, raw[end:]]).decode("utf-8", "surrogatepass")


def remove(
    docs: DataFrame,
    benchmark: DataFrame,
    max_share: float = 0.5,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``docs`` with hit words cut out of their texts; documents with more than ``max_share`` of their words hit go.

    The share is that of all items' hits on the text as it comes. Cutting can bring
    the ends of a passage together, so what was cut is scanned again until nothing
    is hit. Texts without hits stay as they are.
    """
    names = docs.columns
    slices = _slices(benchmark, item, item_text, max_bytes)
    if len(slices) > 1:
        return _remove_sliced(docs, benchmark, max_share, text, item, item_text, window, max_bytes)
    shared = docs.sparkSession.sparkContext.broadcast(_index(slices[0], window))

    def run(batches):
        for batch in (piece for whole in batches for piece in stretches(whole, text, TEXT_BYTES)):
            texts = batch.column(text).to_pylist()
            kept = np.ones(len(texts), dtype=bool)
            for i, (n, runs, _) in enumerate(list(_scan_texts(shared.value, texts))):
                if sum(b - a + 1 for a, b in runs) > max_share * n:
                    kept[i] = False
                    continue
                while runs:
                    texts[i] = cut_spans(texts[i], runs)
                    ((_, runs, _),) = _scan_texts(shared.value, [texts[i]])
            arrays = [pa.array(texts, batch.schema.field(c).type) if c == text else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(arrays, names=names).filter(pa.array(kept))

    return docs.mapInArrow(freeing(run), docs.schema)


def _remove_sliced(docs: DataFrame, benchmark: DataFrame, max_share: float, text: str, item: str, item_text: str, window: int, max_bytes: int) -> DataFrame:
    """``remove`` with the hits of all slices of the benchmark gathered before each cut, as one index would find them."""
    names = [free_name(docs, f"{c}_{k}") for k, c in enumerate(docs.columns)]
    body = names[docs.columns.index(text)]
    # Names of its own: find_hits would replace columns called like its results.
    out = docs.toDF(*names)

    def cut(batches):
        for batch in batches:
            texts = batch.column(body).to_pylist()
            for i, spans in enumerate(batch.column("hit_spans").to_pylist()):
                if spans:
                    texts[i] = cut_spans(texts[i], [(s["first"], s["last"]) for s in spans])
            arrays = [pa.array(texts, batch.schema.field(c).type) if c == body else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array([bool(x) for x in batch.column("hit_spans").to_pylist()], pa.bool_())], names=[*names, "was_cut"])

    schema = T.StructType([*out.schema.fields, T.StructField("was_cut", T.BooleanType())])
    done, first = [], True
    while True:
        found = find_hits(out, benchmark, body, item, item_text, window, max_bytes)
        if first:
            n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
            found = found.where(n_hit <= F.lit(float(max_share)) * F.col("n_words"))
        out, first = land(found.select(*names, "hit_spans").mapInArrow(freeing(cut), schema), "decontaminated"), False
        done.append(out.where(~F.col("was_cut")).select(*names))
        out = out.where("was_cut").select(*names)
        if not out.take(1):
            return reduce(DataFrame.unionAll, done).toDF(*docs.columns)
