"""Alignment of two tokenizers over a corpus, with counts of the id pairs they link.

Every text is encoded by a byte-level tokenizer (A; it gets a space before the
text) and by a piece tokenizer (B; it adds that space itself). Byte offsets at
which a token of both ends cut the two sequences into groups; the two tokens
that end there are linked. A pair's count is how many links of the corpus hold
it.

1. ``tokenise`` writes the ids of every document, and each task the distinct
   pairs it met, to the shared folder. Texts are encoded once.
2. The distinct pairs get a minimal perfect hash, built in shards: in each of
   several levels the keys that have a place of a bit array to themselves keep
   it, the others go on. A pair's index is the rank of its bit.
3. Every task counts links in a dense vector indexed by that hash. Vectors are
   summed in a tree of tasks, segment by segment.
4. A second pass aligns the documents again and looks their pairs up. The pair
   stored at an index is compared first; a pair that is not there is an error.

There can be no more pairs than products of ids, and in practice some millions.
What is sent to the executors, 17 bytes a pair, is measured first; beyond
``MAX_BROADCAST_BYTES`` the shards are taken in slices, each with its own
passes, and the documents' sums are added.

A text has tokens only if both tokenizers give back the bytes of a space and
the text; null and empty texts have none. Documents without tokens have zeros
and an empty string of groups. Null ids stay, repeated rows are documents of
their own. Texts of any length are encoded whole. Extra columns are ignored. An
empty table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import MAX_BROADCAST_BYTES, land
from tallyline.llm.jaccard import mix

# How byte-level vocabularies are split before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# What piece vocabularies write for a space.
SPACE = "▁"

SHARDS = 256
#: Places in a level of the hash for each key that comes to it.
SPARSE = 2
LEVELS = 64
SEGMENT = 1 << 16
FAN_IN = 64
#: Texts encoded, tokens aligned, links held by a task at once.
TEXTS, TOKENS, HELD = 64, 1 << 19, 1 << 21
PAIR_BYTES = 17  # key, count, and what the hash takes

_TOKENS = "row long, id long, a binary, b binary, pairs binary"


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies print bytes as letters: printable ones as they are, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers, and the bytes of their ids."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        import tiktoken

        with open(a_path, encoding="utf-8") as f:
            known = json.load(f)
        special = {t["content"] for t in known["added_tokens"]}
        letters = _byte_of_char()
        ranks = {bytes(letters[c] for c in w): i for w, i in known["model"]["vocab"].items() if w not in special}
        # Ids of this kind of vocabulary are in the order of its merges, so they serve as ranks.
        self.a = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for w, i in ranks.items():
            self.a_bytes[i] = w
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]

    _shared: dict[tuple[str, str], Tokenizers] = {}

    @classmethod
    def shared(cls, a_path: str, b_path: str) -> Tokenizers:
        """One for all tasks of a Python worker."""
        if (a_path, b_path) not in cls._shared:
            cls._shared[a_path, b_path] = cls(a_path, b_path)
        return cls._shared[a_path, b_path]

    def encode(self, texts: list[str | None]) -> list[tuple[list[int], list[int]]]:
        """Ids by A and B; none unless both give back a space and the text."""
        out = []
        for text, b in zip(texts, self.b.encode([t or "" for t in texts], num_threads=1)):
            whole = b" " + (text or "").encode()
            a = self.a.encode_ordinary(" " + text) if text else []
            good = text and b"".join(map(self.a_bytes.__getitem__, a)) == whole == b"".join(map(self.b_bytes.__getitem__, b))
            out.append((a, b) if good else ([], []))
        return out


class Alignment:
    """Documents' ids one after another, and where both sequences end together."""

    def __init__(self, a: np.ndarray, a_counts: np.ndarray, b: np.ndarray, b_counts: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray):
        self.a, self.b, self.a_counts, self.b_counts = a, b, a_counts, b_counts
        # A document has as many bytes in A as in B, so places count on over all documents.
        a_ends, b_ends = np.cumsum(a_sizes[a]), np.cumsum(b_sizes[b])
        self.a_cut, self.b_cut = (np.zeros(len(x), dtype=bool) for x in (a, b))
        if len(a):
            mark = np.zeros(a_ends[-1] + 1, dtype=np.int8)
            mark[a_ends] = 1
            mark[b_ends] += 2
            self.a_cut, self.b_cut = mark[a_ends] == 3, mark[b_ends] == 3
        self.a_link, self.b_link = a[self.a_cut], b[self.b_cut]
        upto = np.concatenate([[0], np.cumsum(self.a_cut)])
        self.links = np.diff(upto[np.concatenate([[0], np.cumsum(a_counts)])])

    def pairs(self, width: int) -> np.ndarray:
        """One key for each link."""
        return self.a_link.astype(np.int64) * width + self.b_link

    def groups(self, names: Names) -> list[str]:
        """Per document the ids of its groups: ``a1,a2|b1;a3|b2,b3``."""
        # Tokens in order of writing: a group's A ids, its B ids, the next group's.
        a_upto, b_upto = (np.concatenate([[0], np.flatnonzero(x) + 1]) for x in (self.a_cut, self.b_cut))
        a_group, b_group = (np.cumsum(x) - x for x in (self.a_cut, self.b_cut))
        order = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        order[np.arange(len(self.a)) + b_upto[a_group]] = self.a + self.a_cut * names.width
        order[np.arange(len(self.b)) + a_upto[b_group + 1]] = self.b + self.b_cut * (2 * names.width)
        ends = np.cumsum(self.a_counts + self.b_counts).tolist()
        words = list(map(names.words.__getitem__, order.tolist()))
        return ["".join(words[s:e])[:-1] for s, e in zip([0, *ends], ends)]


class Names:
    """An id's decimal digits and what follows them: ',' inside a group, '|' after its A ids, ';' after its B ids."""

    def __init__(self, width: int):
        self.width = width
        self.words = [f"{i}{mark}" for mark in ",|;" for i in range(width)]


def tokenise(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Landed: a row per document with both id sequences, and rows of distinct pairs (``pairs``) from each task."""

    def run(batches):
        both = Tokenizers.shared(a_path, b_path)
        a_sizes, b_sizes, width = _sizes(both)
        # Row numbers of a task start at a multiple of 2^40.
        row = TaskContext.get().partitionId() << 40
        held, n_held = [np.empty(0, dtype=np.int64)], 0
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                piece = batch.slice(at, TEXTS)
                ids = both.encode(piece.column("text").to_pylist())
                a, b = ([np.array(x[k], dtype="<u4") for x in ids] for k in (0, 1))
                lined = Alignment(*_joined(a), *_joined(b), a_sizes, b_sizes)
                held.append(np.unique(lined.pairs(width)))
                n_held += len(held[-1])
                if n_held > HELD:
                    held = [np.unique(np.concatenate(held))]
                    n_held = 0
                yield _rows(np.arange(row, row + len(a)), piece.column("id"), [_packed(x) for x in a], [_packed(x) for x in b], None)
                row += len(a)
        yield _rows([None], pa.array([None], pa.int64()), [None], [None], [np.unique(np.concatenate(held)).tobytes()])

    own = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return land(own.mapInArrow(run, _TOKENS), "align-tokens")


def _rows(row, ids: pa.Array, a: list, b: list, pairs: list | None) -> pa.RecordBatch:
    columns = [pa.array(row, pa.int64()), ids, pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(pairs or [None] * len(a), pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["row", "id", "a", "b", "pairs"])


def _packed(ids: np.ndarray) -> bytes:
    """Two bytes an id where that is enough: the length tells which."""
    return b"\2" + ids.astype("<u2").tobytes() if not len(ids) or ids.max() < 1 << 16 else b"\4" + ids.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u2" if data[0] == 2 else "<u4", offset=1)


def _joined(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([np.empty(0, "<u4"), *ids]).astype(np.int64), np.array([len(x) for x in ids], dtype=np.int64)


def _sizes(both: Tokenizers) -> tuple[np.ndarray, np.ndarray, int]:
    """Bytes of every id, and a number beyond all ids."""
    a, b = (np.array(list(map(len, x)), dtype=np.int64) for x in (both.a_bytes, both.b_bytes))
    return a, b, max(len(a), len(b))


def _aligned(batches: Iterable[pa.RecordBatch], sizes: tuple[np.ndarray, np.ndarray, int]) -> Iterator[tuple[pa.RecordBatch, Alignment]]:
    """Documents of ``tokenise`` aligned again, some at a time."""
    for batch in batches:
        a, b = ([_unpacked(x) for x in batch.column(c).to_pylist()] for c in "ab")
        upto = np.cumsum([len(x) for x in a])
        start = 0
        while start < batch.num_rows:
            done = upto[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(upto, done + TOKENS, "right")))
            yield batch.slice(start, end - start), Alignment(*_joined(a[start:end]), *_joined(b[start:end]), *sizes[:2])
            start = end


def _shard_of(pairs: np.ndarray) -> np.ndarray:
    return (mix(pairs.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.int64) % SHARDS


def _place(pairs: np.ndarray, level: int, size: np.ndarray | int) -> np.ndarray:
    """A place below ``size`` at a level."""
    h = mix(pairs.astype(np.uint64) ^ mix(np.array([level + 1], dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)))
    return (((h >> np.uint64(32)) * np.asarray(size, dtype=np.uint64)) >> np.uint64(32)).astype(np.int64)


def build_hash(pairs: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Level sizes and bits of a minimal perfect hash of distinct keys, and the keys in the order of their indexes."""
    sizes, bits, own, rest, start = [], [], [], pairs, 0
    while len(rest):
        if len(sizes) == LEVELS:
            raise ValueError("keys of a minimal perfect hash must be distinct")
        size = -(-SPARSE * len(rest) // 64) * 64
        at = _place(rest, len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        mine = alone[at]
        bits.append(alone)
        own.append((at[mine] + start, rest[mine]))
        sizes.append(size)
        rest, start = rest[~mine], start + size
    if not sizes:
        return [], np.empty(0, np.uint64), pairs
    places, keys = (np.concatenate(x) for x in zip(*own))
    return sizes, np.packbits(np.concatenate(bits), bitorder="little").view("<u8"), keys[np.argsort(places)]


class PairIndex:
    """Indexes of pairs in some shards, by their hashes laid one after another."""

    def __init__(self, shards: list[tuple[int, list[int], bytes, bytes]]):
        self.sizes = np.zeros((SHARDS, LEVELS), dtype=np.int64)
        self.starts = np.zeros((SHARDS, LEVELS), dtype=np.int64)
        self.own = np.zeros(SHARDS, dtype=bool)
        start = 0
        for shard, sizes, _, _ in sorted(shards):
            self.own[shard] = True
            for level, size in enumerate(sizes):
                self.sizes[shard, level], self.starts[shard, level] = size, start
                start += size
        self.bits = np.frombuffer(b"".join(bits for _, _, bits, _ in sorted(shards)), "<u8")
        self.keys = np.frombuffer(b"".join(keys for _, _, _, keys in sorted(shards)), "<i8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.bits), dtype=np.int64)])

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, pairs: np.ndarray) -> np.ndarray:
        """Verified indexes; -1 for pairs of other shards. Unknown pairs of these shards are an error."""
        out = np.full(len(pairs), -1, dtype=np.int64)
        shards = _shard_of(pairs)
        todo = np.flatnonzero(self.own[shards])
        for level in range(LEVELS):
            size = self.sizes[shards[todo], level]
            todo, size = todo[size > 0], size[size > 0]
            if not len(todo):
                break
            at = self.starts[shards[todo], level] + _place(pairs[todo], level, size)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            bits = self.bits[word]
            found = (bits >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(bits & ((np.uint64(1) << bit) - np.uint64(1)))
            out[todo[found]] = (self.before[word] + below)[found]
            todo = todo[~found]
        mine = self.own[shards]
        if len(todo) or not np.array_equal(self.keys[out[mine]], pairs[mine]):
            raise ValueError("a pair is not in the hash that was built from these documents")
        return out


def _shards(tokens: DataFrame) -> DataFrame:
    """Landed: a minimal perfect hash of the distinct pairs of each shard."""

    def deal(batches):
        for batch in batches:
            for data in batch.column("pairs"):
                pairs = np.frombuffer(data.as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(_shard_of(pairs)), pa.array(pairs)], names=["shard", "pair"])

    def build(batches):
        for shard, held in _runs(batches, "shard"):
            pairs = np.unique(np.concatenate([x.column("pair").to_numpy() for x in held]))
            sizes, bits, keys = build_hash(pairs)
            columns = [pa.array([shard], pa.int64()), pa.array([len(keys)], pa.int64()), pa.array([sizes], pa.list_(pa.int64())), pa.array([bits.tobytes()]), pa.array([keys.tobytes()])]
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "n", "sizes", "bits", "keys"])

    dealt = tokens.where("pairs is not null").select("pairs").mapInArrow(deal, "shard long, pair long")
    dealt = dealt.distinct().repartition("shard").sortWithinPartitions("shard")
    return land(dealt.mapInArrow(build, "shard long, n long, sizes array<long>, bits binary, keys binary"), "align-hash")


def _runs(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows with equal values in the named columns, which lie together: (value or values, batches)."""
    last, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [batch.column(c).to_numpy() for c in names]
        cuts = np.flatnonzero(np.any([v[1:] != v[:-1] for v in values], axis=0)) + 1
        bounds = [0, *cuts.tolist(), batch.num_rows]
        for s, e in zip(bounds, bounds[1:]):
            key = tuple(int(v[s]) for v in values)
            if key != last and held:
                yield (last[0] if len(last) == 1 else last), held
                held = []
            last = key
            held.append(batch.slice(s, e - s))
    if held:
        yield (last[0] if len(last) == 1 else last), held


def _slices(shards: DataFrame) -> list[list[int]]:
    """Shards whose tables are small enough to be sent together."""
    out: list[list[int]] = []
    room = 0
    for r in shards.select("shard", "n").orderBy("shard").collect():
        if not out or room < r["n"]:
            out.append([])
            room = MAX_BROADCAST_BYTES // PAIR_BYTES
        out[-1].append(r["shard"])
        room -= r["n"]
    return out


def _index(shards: DataFrame, wanted: list[int]) -> PairIndex:
    rows = shards.where(F.col("shard").isin(wanted)).select("shard", "sizes", "bits", "keys").collect()
    return PairIndex([(r["shard"], r["sizes"], bytes(r["bits"]), bytes(r["keys"])) for r in rows])


def _counts(tokens: DataFrame, index, n: int, sizes) -> np.ndarray:
    """Links of every pair of an index: dense vectors of the tasks, added in a tree."""

    def count(batches):
        known, total = index.value, np.zeros(n, dtype=np.int64)
        for _, lined in _aligned(batches, sizes.value):
            found = known.find(lined.pairs(sizes.value[2]))
            total += np.bincount(found[found >= 0], minlength=n)
        yield _vectors(TaskContext.get().partitionId() // FAN_IN, [(k, total[k * SEGMENT : (k + 1) * SEGMENT]) for k in range(-(-n // SEGMENT))])

    def add(batches):
        for (segment, part), held in _runs(batches, "segment", "part"):
            total = 0
            for batch in held:
                for data in batch.column("vector"):
                    total = total + np.frombuffer(data.as_py(), np.int64)
            yield _vectors(part // FAN_IN, [(segment, total)])

    schema = "segment long, part long, vector binary"
    docs = tokens.where("pairs is null").select("a", "b")
    parts = docs.rdd.getNumPartitions()
    vectors = docs.mapInArrow(count, schema)
    while True:
        parts = -(-parts // FAN_IN)
        vectors = vectors.repartition("segment", "part").sortWithinPartitions("segment", "part").mapInArrow(add, schema)
        if parts <= 1:
            break
    out = np.zeros(n, dtype=np.int64)
    for r in vectors.collect():
        at = r["segment"] * SEGMENT
        out[at : at + SEGMENT] += np.frombuffer(r["vector"], np.int64)
    return out


def _vectors(part: int, segments: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    kept = [(k, v) for k, v in segments if v.any()]
    columns = [pa.array([k for k, _ in kept], pa.int64()), pa.array([part] * len(kept), pa.int64()), pa.array([v.tobytes() for _, v in kept], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["segment", "part", "vector"])


class PairCounts:
    """Counts of all pairs of ``tokenise``'s documents, in slices that can be sent to every executor."""

    def __init__(self, tokens: DataFrame, a_path: str, b_path: str):
        self.tokens = tokens
        self.context = tokens.sparkSession.sparkContext
        sizes = _sizes(Tokenizers.shared(a_path, b_path))
        self.sizes, self.width = self.context.broadcast(sizes), sizes[2]
        self.shards = _shards(tokens)
        self.slices = _slices(self.shards)
        self.best = np.zeros(self.width, dtype=np.int64)
        self.counts: list[np.ndarray] = []
        for wanted in self.slices:
            index = _index(self.shards, wanted)
            sent = self.context.broadcast(index)
            self.counts.append(_counts(tokens, sent, len(index), self.sizes))
            np.maximum.at(self.best, index.keys % self.width, self.counts[-1])
            sent.unpersist()

    def table(self, spark: SparkSession) -> DataFrame:
        """Every pair of ids with its count: a, b, n."""
        width, counts = self.width, self.context.broadcast([c.tobytes() for c in self.counts])
        at = {shard: k for k, wanted in enumerate(self.slices) for shard in wanted}
        starts, total = {}, [0] * len(self.slices)
        for r in self.shards.select("shard", "n").orderBy("shard").collect():
            starts[r["shard"]] = total[at[r["shard"]]]
            total[at[r["shard"]]] += r["n"]

        def run(batches):
            for batch in batches:
                for shard, keys in zip(batch.column("shard").to_pylist(), batch.column("keys").to_pylist()):
                    pairs = np.frombuffer(keys, np.int64)
                    own = np.frombuffer(counts.value[at[shard]], np.int64)[starts[shard] : starts[shard] + len(pairs)]
                    yield pa.RecordBatch.from_arrays([pa.array(pairs // width), pa.array(pairs % width), pa.array(own)], names=["a", "b", "n"])

        return self.shards.select("shard", "keys").mapInArrow(run, "a long, b long, n long")

    def _looked_up(self, k: int, with_groups: bool) -> DataFrame:
        """Per document its sums over the pairs of one slice."""
        index, sizes = self.context.broadcast(_index(self.shards, self.slices[k]) if self.slices else PairIndex([])), self.sizes
        counts, best = self.context.broadcast(self.counts[k] if self.slices else np.empty(0, np.int64)), self.context.broadcast(self.best)

        def run(batches):
            names = Names(sizes.value[2]) if with_groups else None
            for batch, lined in _aligned(batches, sizes.value):
                found = index.value.find(lined.pairs(sizes.value[2]))
                own = np.where(found >= 0, counts.value[found], 0) if len(counts.value) else np.zeros(len(found), np.int64)
                top = (found >= 0) & (own == best.value[lined.b_link])
                ends = np.cumsum(lined.links)
                sums = [np.diff(np.concatenate([[0], np.cumsum(x, dtype=np.int64)])[np.concatenate([[0], ends])]) for x in (top, own)]
                columns = [batch.column("row"), *map(pa.array, sums)]
                if with_groups:
                    columns += [batch.column("id"), *map(pa.array, (lined.a_counts, lined.b_counts, lined.links, lined.links, lined.groups(names)))]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "n_best", "count_sum", "id", "n_a", "n_b", "n_groups", "n_links", "groups"][: len(columns)])

        more = ", id long, n_a long, n_b long, n_groups long, n_links long, groups string" if with_groups else ""
        docs = self.tokens.where("pairs is null").select("row", "id", "a", "b")
        return docs.mapInArrow(run, "row long, n_best long, count_sum long" + more)

    def documents(self) -> DataFrame:
        """Per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups."""
        out = self._looked_up(0, True)
        if len(self.slices) > 1:
            sums = out.select("row", "n_best", "count_sum")
            for k in range(1, len(self.slices)):
                sums = sums.unionByName(self._looked_up(k, False))
            sums = sums.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
            out = out.drop("n_best", "count_sum").join(sums, "row")
        return out.select("id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


def align(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> PairCounts:
    """The documents aligned and all their pairs counted."""
    return PairCounts(tokenise(docs, a_path, b_path, key, text), a_path, b_path)
