"""Language-model scores from an Elias-Fano n-gram trie.

The model predicts a token from the one before it, with Dirichlet smoothing:
P(w | h) = (c(h, w) + m P(w)) / (c(h) + m), P(w) by add-one counts. Its
vocabulary are all training tokens; unigram counts cover all tokens and pair
counts all pairs of the training documents; nothing is pruned or merged. Only
who asks for it (``size``) gets a smaller vocabulary: then the tokens below the
least count that at most so many reach are one class, in which each has its
add-one share.

Pairs are shuffled once: a shard holds the pairs of some followers with the
documents they occur in, so that it can count them, put them into a trie and
answer all documents' queries itself. A task holds pairs until it has HELD_PAIRS
of them, then writes one row for each shard, sorted and packed; a row has hundreds
of pairs or more as long as there are fewer than some thousand shards, and never
less than one. The CACHED most
frequent tokens have short ids that are broadcast with their counts; any other
goes by a 64-bit hash of its bytes, and its shard, which sees all its
occurrences, counts it (two tokens of one hash would be taken for one: a chance
of 0.0003 in all for 100 million tokens). A follower with more pairs than a shard
should hold is split over shards; it is always a cached one.
A document runs in a circle from its end to its end, so its contexts and its
followers are the same tokens: the sum of log P(w | h) is that of
log (c(h, w) + m P(w)) / (c(w) + m), which needs no count of the context. These
values are the trie's. Its levels (followers, pointers, contexts of each) are
Elias-Fano sequences in memory-mapped buffers (or files), with values quantised
to 1/QUANT of a decimal digit. A query finds its follower by successor search in the first
level, reads the range of its contexts off the pointers, and searches the context
relative to its follower.

Tokens are words between ASCII white space, A to Z lower-cased, then one end.
Null texts are empty: only the end. Null ids are scored too, and count as not
held out by a rule on the id. Repeated rows are documents like any other. An
empty table gives no rows; without training documents all tokens are unknown.
"""

from __future__ import annotations

import mmap
import os
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import LOWER_ASCII, freeing, land, stretches

#: Tokens whose ids and counts are broadcast; it bounds no result.
CACHED = 1 << 18
SMOOTHING = 64.0
QUANT = 2048
ID_BITS = 20
#: Ids of a shard's part of a batch.
PART_BITS = 31
BATCH_DOCS = 1 << 12
BATCH_WORDS = 1 << 17
#: Pairs that a task holds, at 16 bytes each, before it deals them to shards.
HELD_PAIRS = 1 << 22
#: Bytes of packed rows that are handed on at once.
EMIT_BYTES = 1 << 23
SHARD_PAIRS = 1 << 20
COUNT_WORDS = 1 << 18
#: Bytes of texts, and values of a shard, that are worked on at once: what lies beside them stays small.
TEXT_BYTES = 1 << 21
STEP = 1 << 16
#: No token is a blank, as tokens hold no white space.
END = b" "

_U = np.uint64


def _steps(n: int) -> Iterator[slice]:
    return (slice(a, min(n, a + STEP)) for a in range(0, n, STEP))


def tokens_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER_ASCII).split()


class EliasFano:
    """A non-decreasing sequence below a bound: low bits packed, high bits in unary."""

    def __init__(self, n: int, shift: int, low: np.ndarray, high: np.ndarray):
        self.n, self.shift, self.low, self.high = n, shift, low, high
        ones = np.bitwise_count(high).astype(np.int64)
        self.ones = np.concatenate([[0], np.cumsum(ones)])
        self.zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones

    @classmethod
    def build(cls, values: np.ndarray, bound: int) -> EliasFano:
        n = len(values)
        shift = max(0, (bound // max(n, 1)).bit_length() - 1)
        low = np.zeros(n * shift // 64 + 2, dtype=np.uint64)
        bits = np.zeros((n + (bound >> shift) + 2 + 63) // 64 * 64, dtype=np.uint8)
        for step in _steps(n):
            i = np.arange(step.start, step.stop, dtype=np.int64)
            bits[(values[step] >> shift) + i] = 1
            if shift:
                part = values[step].astype(np.uint64) & _U((1 << shift) - 1)
                at = i * shift
                word, bit = at >> 6, (at & 63).astype(np.uint64)
                np.bitwise_or.at(low, word, part << bit)
                over = bit + _U(shift) > _U(64)
                np.bitwise_or.at(low, word[over] + 1, part[over] >> (_U(64) - bit[over]))
        return cls(n, shift, low, np.packbits(bits, bitorder="little").view(np.uint64))

    def save(self, stem: str) -> None:
        np.save(stem + ".low.npy", self.low)
        np.save(stem + ".high.npy", self.high)
        np.save(stem + ".size.npy", np.array([self.n, self.shift]))

    @classmethod
    def open(cls, stem: str) -> EliasFano:
        n, shift = np.load(stem + ".size.npy").tolist()
        return cls(n, shift, np.load(stem + ".low.npy", mmap_mode="r"), np.load(stem + ".high.npy", mmap_mode="r"))

    def _select(self, k: np.ndarray, ranks: np.ndarray, flip: bool) -> np.ndarray:
        """Positions of the k-th (from 0) ones, or zeros."""
        word = np.searchsorted(ranks, k, "right") - 1
        left = k - ranks[word]
        x = np.asarray(self.high[word])
        if flip:
            x = ~x
        at = np.zeros(len(k), dtype=np.int64)
        for step in (32, 16, 8, 4, 2, 1):
            ones = np.bitwise_count(x & _U((1 << step) - 1)).astype(np.int64)
            go = left >= ones
            left = np.where(go, left - ones, left)
            x = np.where(go, x >> _U(step), x)
            at += step * go
        return word * 64 + at

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.shift:
            return np.zeros(len(i), dtype=np.int64)
        at = i * self.shift
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        x = (self.low[word] >> bit) | np.where(bit > 0, self.low[word + 1] << ((_U(64) - bit) & _U(63)), _U(0))
        return (x & _U((1 << self.shift) - 1)).astype(np.int64)

    def access(self, i: np.ndarray) -> np.ndarray:
        """The i-th values."""
        return ((self._select(i, self.ones, False) - i) << self.shift) | self._low(i)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first value not below each x (n if none), and whether it equals x."""
        bucket = x >> self.shift
        low = x & ((1 << self.shift) - 1)
        end = self._select(bucket, self.zeros, True) - bucket
        i = np.where(bucket > 0, self._select(np.maximum(bucket - 1, 0), self.zeros, True) - bucket + 1, 0)
        # Buckets of clustered values are long, so they are halved and not walked.
        stop = end.copy()
        open_ = np.flatnonzero(i < stop)
        while len(open_):
            middle = (i[open_] + stop[open_]) >> 1
            below = self._low(middle) < low[open_]
            i[open_[below]] = middle[below] + 1
            stop[open_[~below]] = middle[~below]
            open_ = open_[i[open_] < stop[open_]]
        same = i < end
        at = np.flatnonzero(same)
        same[at] = self._low(i[at]) == low[at]
        return i, same


class NgramTrie:
    """Two levels: followers, and the contexts of each with a quantised log10 value."""

    def __init__(self, followers: EliasFano, pointers: EliasFano, contexts: EliasFano, quantised: np.ndarray, bits: int):
        self.followers, self.pointers, self.contexts, self.quantised, self.bits = followers, pointers, contexts, quantised, bits

    @classmethod
    def build(cls, keys: np.ndarray, log10: np.ndarray, bits: int = ID_BITS) -> NgramTrie:
        """``keys``: follower << bits | context, ascending."""
        w = keys >> bits
        first = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]])) if len(keys) else np.empty(0, dtype=np.int64)
        w = w[first]
        relative = np.repeat(np.arange(len(first)) << bits, np.diff(np.append(first, len(keys))))
        for step in _steps(len(keys)):
            relative[step] |= keys[step] & ((1 << bits) - 1)
        return cls(
            EliasFano.build(w, 1 << bits),
            EliasFano.build(np.append(first, len(keys)), len(keys) + 1),
            EliasFano.build(relative, max(1, len(first)) << bits),
            np.clip(np.rint(-log10 * QUANT), 0, 65535).astype(np.uint16),
            bits,
        )

    def save(self, folder: str) -> None:
        for name in ("followers", "pointers", "contexts"):
            getattr(self, name).save(os.path.join(folder, name))
        np.save(os.path.join(folder, "quantised.npy"), self.quantised)
        np.save(os.path.join(folder, "bits.npy"), self.bits)

    @classmethod
    def open(cls, folder: str) -> NgramTrie:
        parts = (EliasFano.open(os.path.join(folder, x)) for x in ("followers", "pointers", "contexts"))
        return cls(*parts, np.load(os.path.join(folder, "quantised.npy"), mmap_mode="r"), int(np.load(os.path.join(folder, "bits.npy"))))

    def mapped(self) -> NgramTrie:
        """The same trie with its levels in one anonymous memory map: nothing of it is on a local disk."""
        sequences = (self.followers, self.pointers, self.contexts)
        arrays = [a for x in sequences for a in (x.low, x.high)] + [self.quantised]
        starts = np.cumsum([0, *(-(-a.nbytes // 8) * 8 for a in arrays)]).tolist()
        space = mmap.mmap(-1, max(8, starts[-1]))
        views = []
        for a, at in zip(arrays, starts):
            view = np.frombuffer(space, a.dtype, len(a), at)
            view[:] = a
            views.append(view)
        levels = [EliasFano(x.n, x.shift, low, high) for x, low, high in zip(sequences, views[0::2], views[1::2])]
        return NgramTrie(*levels, views[-1], self.bits)

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """The stored log10 values; nan where the trie has no such pair."""
        out = np.full(len(keys), np.nan)
        for step in _steps(len(keys) if self.contexts.n else 0):
            asked = keys[step]
            rank, known = self.followers.successor(asked >> self.bits)
            at = np.flatnonzero(known)
            rank = rank[at]
            # Relative to its follower: only the range the pointers give can hold the context.
            low, high = self.pointers.access(rank), self.pointers.access(rank + 1)
            i, same = self.contexts.successor((rank << self.bits) | (asked[at] & ((1 << self.bits) - 1)))
            found = same & (i >= low) & (i < high)
            out[step.start + at[found]] = self.quantised[i[found]] / -float(QUANT)
        return out


class Vocabulary:
    """Ids and counts of some tokens, the end among them; id 0 is all others taken together."""

    def __init__(self, words: list[bytes], counts: list[int], total: int, distinct: int):
        self.ids = {w: i + 1 for i, w in enumerate(words)}
        self.end = self.ids[END]
        self.total, self.distinct = total, distinct
        rare, rare_kinds = total - sum(counts), distinct - sum(c > 0 for c in counts)
        self.counts = np.array([rare, *counts], dtype=np.int64)
        #: Add-one mass of the rare class, with one for all unknown tokens.
        self.rare_mass = rare + rare_kinds + 1
        self.unigram = np.array([self.rare_mass, *(c + 1 for c in counts)], dtype=np.float64) / (total + distinct + 1)

    def __reduce__(self):
        # Rebuilt from plain lists: much smaller to send than the dictionary.
        words = sorted(self.ids, key=self.ids.__getitem__)
        return Vocabulary, (words, self.counts[1:].tolist(), self.total, self.distinct)


def _pack(a: np.ndarray, packer: zstandard.ZstdCompressor) -> bytes:
    """Byte planes, compressed."""
    return packer.compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())


def _unpack(data: bytes, dtype, n: int, opener: zstandard.ZstdDecompressor) -> np.ndarray:
    raw = np.frombuffer(opener.decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(dtype).itemsize, n).T).view(dtype).ravel()


def _count(docs: DataFrame) -> DataFrame:
    """All tokens with their counts in the training documents (c) and the others (other), added up within tasks first."""

    def run(batches):
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> Iterator[pa.RecordBatch]:
            for train, counted in zip((False, True), seen):
                if counted:
                    n = pa.array(list(counted.values()), pa.int64())
                    none = pa.array(np.zeros(len(counted), dtype=np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(list(counted), pa.binary()), n if train else none, none if train else n], names=["word", "c", "other"])
                    counted.clear()

        for batch in (b for whole in batches for b in stretches(whole, "text", TEXT_BYTES)):
            for train, text in zip(batch.column("train").to_pylist(), batch.column("text").to_pylist()):
                counted = seen[train]
                counted.update(tokens_of(text))
                counted[END] += 1
                if len(seen[0]) + len(seen[1]) > COUNT_WORDS:
                    yield from flush()
        yield from flush()

    made = docs.select("train", "text").mapInArrow(freeing(run), "word binary, c long, other long")
    return made.groupBy("word").agg(F.sum("c").alias("c"), F.sum("other").alias("other"))


def _hash(word: bytes) -> int:
    return int.from_bytes(blake2b(word, digest_size=8).digest(), "little")


CODED = """kind string, batch long, first long, ids array<long>, train array<boolean>, n_tokens array<long>, n_known array<long>, base array<double>,
words array<binary>, at array<int>, times array<long>, shard int, n int, keys binary, docs binary, counts binary, hashes binary, n_hashes int"""


def _code(docs: DataFrame, vocabulary, shards: int, merge: bool) -> DataFrame:
    """Batches of documents: what each document has at once, its pairs by shard, and its rare tokens if they are merged.

    A batch's documents are read in stretches, each coded by itself. Its rows of
    one shard hold the pairs of all of them.
    """
    schema = pa.schema(
        [("kind", pa.string()), ("batch", pa.int64()), ("first", pa.int64()), ("ids", pa.list_(pa.int64())), ("train", pa.list_(pa.bool_())), ("n_tokens", pa.list_(pa.int64())), ("n_known", pa.list_(pa.int64())), ("base", pa.list_(pa.float64())), ("words", pa.list_(pa.binary())), ("at", pa.list_(pa.int32())), ("times", pa.list_(pa.int64())), ("shard", pa.int32()), ("n", pa.int32())]
        + [(x, pa.binary()) for x in ("keys", "docs", "counts", "hashes")]
        + [("n_hashes", pa.int32())]
    )

    def run(batches):
        known, hot = vocabulary.value
        get, end, cached = known.ids.get, known.end, len(known.counts)
        log_counts = np.log10(known.counts + 1.0)
        log_counts[0] = 0.0
        part, number, first = TaskContext.get().partitionId(), 0, 0
        packer = zstandard.ZstdCompressor(level=1)
        # Of the batch at hand: sorted by shard, (followers, contexts, documents, counts, where shards begin); hashes of tokens without an id.
        coded_parts: list[tuple] = []
        names_of: list[np.ndarray] = []

        def documents(held: list[tuple]) -> Iterator[dict]:
            """Codes a stretch of documents: its info rows; its pairs are kept."""
            nonlocal first
            batch = (part << 32) | number
            flat: list[int] = []
            sizes, words, at, times = [], [], [], []
            others: dict[bytes, int] = {}
            for i, (_, _, tokens) in enumerate(held):
                if merge:
                    coded = [get(w, 0) for w in tokens]
                else:
                    coded = [get(w) or others.setdefault(w, cached + len(others)) for w in tokens]
                if merge and 0 in coded:
                    for w, k in Counter(w for w, c in zip(tokens, coded) if not c).items():
                        words.append(w)
                        at.append(first + i)
                        times.append(k)
                flat.append(end)
                flat.extend(coded)
                sizes.append(len(coded) + 1)
            ids = np.array(flat, dtype=np.int64)
            doc = np.repeat(np.arange(len(held)), sizes)
            # Each document is end, words; followed by words, end.
            after = np.append(ids[1:], end)
            after[np.cumsum(sizes) - 1] = end
            frequent = np.where(after < cached, after, 0)
            seen = known.counts[frequent] * (frequent > 0) > 0
            n = len(held)
            yield {
                "kind": "info",
                "batch": batch,
                "first": first,
                "ids": [i for i, _, _ in held],
                "train": [t for _, t, _ in held],
                "n_tokens": sizes,
                "n_known": np.bincount(doc, seen, n).astype(np.int64),
                "base": np.bincount(doc, log_counts[frequent], n),
            }
            if words:
                yield {"kind": "rare", "batch": batch, "words": words, "at": at, "times": times}
            hashes = np.array([_hash(w) for w in others], dtype=np.uint64)
            bits, doc_bits = (cached + len(others)).bit_length(), (n - 1).bit_length()
            both = (after << bits | ids) << doc_bits | doc
            both, counts = np.unique(both, return_counts=True)
            w, h, doc = both >> (bits + doc_bits), (both >> doc_bits) & ((1 << bits) - 1), both & ((1 << doc_bits) - 1)
            # What all batches call a token: its id, or its hash.
            names = np.concatenate([np.arange(cached, dtype=np.uint64), hashes])
            split = np.concatenate([hot, np.zeros(len(others), dtype=bool)])[w]
            mixed = (names[w] + np.where(split, names[h] * _U(0xFF51AFD7ED558CCD), _U(0))) * _U(0x9E3779B97F4A7C15)
            shard = ((mixed >> _U(32)) % _U(shards)).astype(np.int32)
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            # Tokens without an id are numbered on over the stretches of a batch.
            before = sum(len(x) for x in names_of)
            names_of.append(hashes)
            w, h = (np.where(x >= cached, x + before, x)[order].astype(np.uint32) for x in (w, h))
            trained = np.array([t for _, t, _ in held], dtype=np.uint32)[doc]
            doc = (first + doc).astype(np.uint32) << np.uint32(1) | trained
            coded_parts.append((w, h, doc[order], counts[order].astype(np.uint32), cuts))
            first += n

        def deal() -> Iterator[dict]:
            """The batch's pairs, a row for each shard that has any."""
            nonlocal number, first
            batch, hashes = (part << 32) | number, np.concatenate(names_of)
            for s in range(shards):
                mine = [(p, slice(p[4][s], p[4][s + 1])) for p in coded_parts if p[4][s] < p[4][s + 1]]
                if not mine:
                    continue
                w, h, doc, counts = (np.concatenate([p[k][cut] for p, cut in mine]) for k in range(4))
                pair = np.stack([w, h]).astype(np.int64)
                long = pair >= cached
                other, place = np.unique(hashes[pair[long] - cached], return_inverse=True)
                pair[long] = cached + place
                key = pair[0] << PART_BITS | pair[1]
                order = np.argsort(key, kind="stable")
                yield {
                    "kind": "pairs",
                    "batch": batch,
                    "shard": s,
                    "n": len(key),
                    "keys": _pack(np.diff(key[order], prepend=0), packer),
                    "hashes": _pack(other, packer),
                    "n_hashes": len(other),
                    "docs": _pack(doc[order], packer),
                    "counts": _pack(counts[order], packer),
                }
            coded_parts.clear()
            names_of.clear()
            number, first = number + 1, 0

        def rows(held: list[tuple]) -> Iterator[dict]:
            yield from documents(held)
            if sum(len(p[0]) for p in coded_parts) >= HELD_PAIRS:
                yield from deal()

        def held_documents() -> Iterator[list[tuple]]:
            held, size = [], 0
            for batch in (b for whole in batches for b in stretches(whole, "text", TEXT_BYTES)):
                for i, train, text in zip(*(batch.column(c).to_pylist() for c in ("id", "train", "text"))):
                    tokens = tokens_of(text)
                    if held and len(tokens) >= BATCH_WORDS:
                        # Alone, so that its keys are short.
                        yield held
                        held, size = [], 0
                    held.append((i, train, tokens))
                    size += len(tokens) + 1
                    if len(held) == BATCH_DOCS or size >= BATCH_WORDS:
                        yield held
                        held, size = [], 0
            if held:
                yield held

        def all_rows() -> Iterator[dict]:
            for held in held_documents():
                yield from rows(held)
            if coded_parts:
                yield from deal()

        def record_batch(made: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in made], f.type) for f in schema], schema=schema)

        made, size = [], 0
        for row in all_rows():
            made.append(row)
            size += 64 * len(row.get("ids", ())) + sum(len(row.get(c, b"")) for c in ("keys", "docs", "counts", "hashes"))
            if size >= EMIT_BYTES:
                yield record_batch(made)
                made, size = [], 0
        if made:
            yield record_batch(made)

    return docs.mapInArrow(freeing(run), CODED)


def _score_pairs(pairs: DataFrame, frequent, shards: int, smoothing: float) -> DataFrame:
    """Per batch, parts of its documents' log10 sums, and what tokens without an id add to known tokens and base scores."""

    def run(batches):
        cached_counts, cached_unigram, mass = frequent.value
        cached = len(cached_counts)
        rows = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("batch", "n", "keys", "docs", "counts", "hashes", "n_hashes")))]
        if not rows:
            return
        opener = zstandard.ZstdDecompressor()
        part = [_unpack(r[5], np.uint64, r[6], opener) for r in rows]
        hashes, rank = np.unique(np.concatenate(part), return_inverse=True)
        bits = max(ID_BITS, (cached + len(hashes)).bit_length())
        keys, begin = [], 0
        for r, mine in zip(rows, part):
            # Ids of this batch's part become ids of the shard.
            ids = rank[begin : begin + len(mine)] + cached
            begin += len(mine)
            key = np.cumsum(_unpack(r[2], np.int64, r[1], opener))
            both = np.stack([key >> PART_BITS, key & ((1 << PART_BITS) - 1)])
            long = both >= cached
            both[long] = ids[both[long] - cached]
            keys.append(both[0] << bits | both[1])
        sizes = [r[1] for r in rows]
        doc = np.concatenate([_unpack(r[3], np.uint32, r[1], opener) for r in rows])
        counts = np.concatenate([_unpack(r[4], np.uint32, r[1], opener) for r in rows])
        numbers, rows, part, rank = [r[0] for r in rows], None, None, None
        # A shard has some million pairs: an array of all of them goes as soon as it can.
        keys = np.concatenate(keys)
        asked, place = np.unique(keys, return_inverse=True)
        keys, place = None, place.astype(np.uint32)
        c = np.bincount(place, counts * (doc & np.uint32(1)), len(asked))
        # A token without an id has all its occurrences as a follower here.
        long = np.searchsorted(asked, cached << bits)
        own = np.bincount((asked[long:] >> bits) - cached, c[long:], len(hashes))
        followers = np.concatenate([cached_counts, own])
        unigram = np.concatenate([cached_unigram, (own + 1) / mass])

        def smoothed(step: slice, times) -> np.ndarray:
            w = asked[step] >> bits
            return np.log10((times + smoothing * unigram[w]) / (followers[w] + smoothing))

        in_model = c > 0
        learned = np.concatenate([smoothed(step, c[step])[in_model[step]] for step in _steps(len(asked))])
        c = None
        trie = NgramTrie.build(asked[in_model], learned, bits).mapped()
        learned = in_model = None
        value = trie.log10(asked)
        for step in _steps(len(asked)):
            value[step] = np.where(np.isnan(value[step]), smoothed(step, 0.0), value[step])
        made, b = [], 0
        for number, size in zip(numbers, sizes):
            a, b = b, b + size
            docs, pair, n = (doc[a:b] >> np.uint32(1)).astype(np.int64), place[a:b], counts[a:b].astype(np.int64)
            sums = np.bincount(docs, n * value[pair])
            at = np.flatnonzero(np.bincount(docs))
            token = asked[pair] >> bits
            long = np.flatnonzero(token >= cached)
            times, seen = n[long], own[token[long] - cached]
            long = docs[long]
            found = np.bincount(long, times * (seen > 0))
            base = np.bincount(long, times * np.log10(seen + 1.0))
            long = np.unique(long[seen > 0])
            made.append((number, at, sums[at], long, found[long].astype(np.int64), base[long]))
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in made], t) for i, t in enumerate(types)], names=names)

    names = ["batch", "at", "sums", "rare_at", "rare_known", "rare_base"]
    long, double = pa.list_(pa.int64()), pa.list_(pa.float64())
    types = [pa.int64(), long, double, long, long, double]
    # A shard is a task: it is its own partition number.
    dealt = pairs.select("shard", "batch", "n", "keys", "docs", "counts", "hashes", "n_hashes").repartitionById(shards, "shard")
    return dealt.mapInArrow(
        freeing(run), "batch long, at array<long>, sums array<double>, rare_at array<long>, rare_known array<long>, rare_base array<double>"
    )


def _add_up(parts: DataFrame) -> DataFrame:
    """One sum of each kind per document of each batch."""

    def run(batches):
        sums: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for b in batches:
            columns = (b.column(c) for c in ("at", "sums", "rare_at", "rare_known", "rare_base"))
            for batch, at, values, rare_at, rare_known, rare_base in zip(b.column("batch").to_pylist(), *columns):
                at = at.values.to_numpy()
                total, known, base = sums.get(batch) or (np.zeros(0), np.zeros(0, dtype=np.int64), np.zeros(0))
                if len(total) <= at[-1]:
                    more = 2 * at[-1] + 1 - len(total)
                    total, known, base = (np.append(x, np.zeros(more, dtype=x.dtype)) for x in (total, known, base))
                sums[batch] = total, known, base
                total[at] += values.values.to_numpy()
                rare = rare_at.values.to_numpy()
                known[rare] += rare_known.values.to_numpy()
                base[rare] += rare_base.values.to_numpy()
        for batch, (total, known, base) in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(total), batch)), pa.array(np.arange(len(total))), pa.array(total), pa.array(known), pa.array(base)],
                names=["batch", "at", "pairs", "more_known", "more_base"],
            )

    return parts.repartition("batch").mapInArrow(freeing(run), "batch long, at long, pairs double, more_known long, more_base double")


def _least_count(counts: DataFrame, size: int, count: Column) -> int:
    """The least count that at most ``size`` tokens reach; found on sums alone, 64 thresholds at a time."""
    low, high = 0, (counts.agg(F.max(count)).first()[0] or 0) + 1
    while high - low > 1:
        steps = sorted({low + (high - low) * k // 65 for k in range(1, 65)} - {low})
        reached = counts.agg(*(F.count_if(count >= t).alias(str(t)) for t in steps)).first()
        enough = [t for t, n in zip(steps, reached) if n <= size]
        high = min(enough, default=high)
        low = max([t for t in steps if t < high], default=low)
    return high


def score(docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text", size: int | None = None, smoothing: float = SMOOTHING) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    ``held_out`` marks the rows the model must not learn from. ``base_score`` is
    the add-one unigram log10 probability. ``size`` merges all but so many tokens
    into one class; without it none are.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"), (~F.coalesce(held_out, F.lit(False))).alias("train"))
    counts = land(_count(rows), "lm-counts")
    zero = lambda c: F.coalesce(c, F.lit(0))
    total, distinct, everything = counts.agg(zero(F.sum("c")), F.count_if(F.col("c") > 0), zero(F.sum(F.col("c") + F.col("other")))).first()
    merge = size is not None
    # A token only held-out documents have can be as frequent in a shard as any.
    count = F.col("c") if merge else F.col("c") + F.col("other")
    top = counts.where(count >= _least_count(counts, size if merge else CACHED, count)).toArrow()
    words, trained = top.column("word").to_pylist(), top.column("c").to_pylist()
    met = (top.column("c").to_numpy() + top.column("other").to_numpy()).tolist()
    if END not in words:
        # The end always has an id; only a tiny vocabulary would leave it out.
        ends = counts.where(F.col("word") == F.lit(END)).collect()
        words.append(END)
        trained.append(sum(r["c"] for r in ends))
        met.append(sum(r["c"] + r["other"] for r in ends))
    known = Vocabulary(words, trained, total, distinct)
    rare_mass = float(known.rare_mass)
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-everything // SHARD_PAIRS))
    # Followers too frequent for one shard are split by context.
    hot = np.array([everything, *met]) > max(1, everything // (8 * shards))
    shared = spark.sparkContext.broadcast((known, hot))
    # Shards need no words.
    frequent = spark.sparkContext.broadcast((known.counts, known.unigram, total + distinct + 1))

    coded = land(_code(rows, shared, shards, merge), "lm-coded", ("kind",))
    info = coded.where("kind = 'info'").select("batch", "first", F.posexplode(F.arrays_zip("ids", "train", "n_tokens", "n_known", "base")).alias("at", "d"))
    info = info.select("batch", (F.col("first") + F.col("at")).alias("at"), "d.*")
    pairs = _add_up(_score_pairs(coded.where("kind = 'pairs'"), frequent, shards, smoothing))
    made = info.join(pairs, ["batch", "at"])
    n_known, base, total_score = F.col("n_known") + F.col("more_known"), F.col("base") + F.col("more_base"), F.col("pairs")
    if merge:
        rare = coded.where("kind = 'rare'").select("batch", F.explode(F.arrays_zip("words", "at", "times")).alias("r")).select(
            "batch", F.col("r.words").alias("words"), F.col("r.at").cast("long").alias("at"), F.col("r.times").alias("times")
        )
        rare = rare.join(counts.withColumnRenamed("word", "words"), "words", "left")
        rare = rare.groupBy("batch", "at").agg(
            F.sum("times").alias("rare"),
            F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
            F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 1.0)).alias("rare_base"),
        )
        made = made.join(rare, ["batch", "at"], "left")
        n_known, base = n_known + zero("rare_known"), base + zero("rare_base")
        total_score = total_score + zero("rare_base") - zero("rare") * F.lit(float(np.log10(rare_mass)))
    all_mass = float(np.log10(total + distinct + 1.0))
    return made.select(
        F.col("ids").alias("id"),
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        n_known.alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (base - F.col("n_tokens") * F.lit(all_mass)).alias("base_score"),
        total_score.alias("score"),
    )
