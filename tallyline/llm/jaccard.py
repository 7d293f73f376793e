"""Similarity join of documents on word n-grams by PartEnum signatures, exact.

Two documents link when the Jaccard similarity of their shingle sets reaches a
threshold. Sets are put in bands of like size. Within a band linked sets differ
in at most k shingles. The domain of shingles is split into n1 partitions, so
that linked sets differ by at most one shingle in one of them; each partition is
split into n2 parts, and every way to leave out one part gives a signature: a
hash of the shingles in the others. Linked sets share a signature, always.

What follows is exact too:

1. Equal sets form one class and sign once.
2. Signatures are shuffled with the id alone; those of a single class go.
3. Among the classes of a signature a parity bitmap of the sets gives a lower
   bound of their difference. What it does not rule out is a candidate.
4. A spanning forest of the candidates, closest first, is verified on whole
   sets. Groups of like documents then hang together and need no more pairs.
5. Candidates that still lie in different components are verified too. Then no
   link can join two components.

Signatures of many classes are cut into tiles, so that no task holds more than
two tiles; no group's pairs are emitted as such.

Null and empty texts have no shingles and link with nothing. Texts of fewer
words than a shingle have one, of all their words. Null ids take part in no
link and have no component. Ids should be unique; of several texts under one
id the largest set (ties: by hash) decides the links of all of them. Extra
columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import LOWER_ASCII, MAX_BROADCAST_BYTES, components, freeing, land

SHINGLE = 4
THRESHOLD = (85, 100)
PARTS = 3
BAND_RATIO = 1.3
MIN_BITMAP_BITS = 256
#: A signature of at most so many classes is known by them.
SMALL_BUCKET = 1 << 16
TILE = 2048
CACHE_WORDS = 200_000
RECORD = 24  # bytes of an id in a broadcast table

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: str | None, n: int, hashes: WordHashes) -> np.ndarray:
    """The distinct shingle hashes of a text, sorted."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER_ASCII).split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    n = min(n, len(w))
    out = np.full(len(w) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + w[k : len(w) - n + 1 + k])
    return np.unique(out)


def max_difference(total: int, threshold: tuple[int, int]) -> int:
    """The most shingles in which linked sets of ``total`` shingles together can differ."""
    a, b = threshold
    return (b - a) * total // (a + b)


class Bands:
    """Size bands; the smaller set of a pair decides the band in which it is found."""

    def __init__(self, threshold: tuple[int, int]):
        self.a, self.b = threshold
        self.low, self.high = [1], []

    def _reach(self, size: int) -> None:
        while self.low[-1] <= size:
            low = self.low[-1]
            # Neighbouring bands must reach further than two linked sizes lie apart.
            self.high.append(max(int(low * BAND_RATIO), -(-low * self.b // self.a)))
            self.low.append(self.high[-1] + 1)

    def of(self, size: int) -> list[int]:
        """The bands a set signs in: its own, and lower ones that hold sizes it can link with."""
        self._reach(size)
        own = int(np.searchsorted(self.low, size, "right")) - 1
        out = [own]
        while out[-1] > 0 and self.a * size <= self.b * self.high[out[-1] - 1]:
            out.append(out[-1] - 1)
        return out

    def differences(self, band: int) -> int:
        """The most in which a set of this band differs from an equal or larger one it links with."""
        return (self.b - self.a) * self.high[band] // self.a


def signatures(s: np.ndarray, bands: Bands, parts: int = PARTS) -> np.ndarray:
    """All PartEnum signatures of a set. Bands in which only equal sets link have none."""
    out = []
    for band in bands.of(len(s)):
        k = bands.differences(band)
        if not k:
            continue
        partitions = k // 2 + 1  # one of them holds at most one difference
        cells = partitions * parts
        spread = mix(s + np.uint64((band + 1) * 0xD1B54A32D192ED03 % 2**64))
        cell = ((spread >> np.uint64(32)) * np.uint64(cells)) >> np.uint64(32)
        sums = np.zeros(cells, dtype=np.uint64)
        np.add.at(sums, cell.astype(np.int64), mix(spread))
        sums = sums.reshape(partitions, parts)
        left_out = sums.sum(axis=1, keepdims=True, dtype=np.uint64) - sums
        place = np.arange(cells, dtype=np.uint64) + np.uint64(band) * np.uint64(1 << 32)
        out.append(mix(left_out.ravel() + mix(place)))
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint64)


def bitmap(s: np.ndarray) -> np.ndarray:
    """Parities of as many hash classes as the set has members, up to the next power of 2.

    Two bitmaps differ in at most as many bits as their sets, also after a
    longer one is folded to the length of the other.
    """
    bits = max(MIN_BITMAP_BITS, 1 << (len(s) - 1).bit_length() if len(s) else 0)
    odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def folded(maps: list[np.ndarray]) -> np.ndarray:
    """Bitmaps as rows of one matrix, all as long as the shortest."""
    words = min(map(len, maps))
    return np.stack([m if len(m) == words else np.bitwise_xor.reduce(m.reshape(-1, words)) for m in maps])


def _profile(docs: DataFrame, n: int) -> DataFrame:
    """Per row: id, size of its set, two hashes of the set, bitmap."""

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            sizes, high, low, maps = [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingles(text, n, hashes)
                sizes.append(len(s))
                high.append(int(mix(s).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
                low.append(int(mix(s ^ _M1).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
                maps.append(bitmap(s))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(maps, pa.list_(pa.int64()))],
                names=["id", "n", "high", "low", "map"],
            )

    return docs.mapInArrow(freeing(run), "id long, n long, high long, low long, map array<long>")


def _sign(docs: DataFrame, n: int, threshold: tuple[int, int]) -> DataFrame:
    def run(batches):
        hashes, bands = WordHashes(), Bands(threshold)
        for batch in batches:
            for part in range(0, batch.num_rows, 256):
                piece = batch.slice(part, 256)
                sigs = [signatures(s, bands) if len(s := shingles(t, n, hashes)) else s for t in piece.column("text").to_pylist()]
                ids = np.repeat(np.array(piece.column("id").to_pylist(), dtype=np.int64), [len(x) for x in sigs])
                both = np.concatenate(sigs).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(both, pa.int64()), pa.array(ids, pa.int64())], names=["sig", "id"])

    return docs.mapInArrow(freeing(run), "sig long, id long")


def _shared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (sig, id), sorted by both, of signatures that more than one id has.

    The signature is replaced by a hash of its ids, as the many signatures that
    the same ids share need to be looked at once only. Should two hashes agree,
    their ids are looked at together, which loses nothing. Ids of a signature
    that has more than are held at once keep it.
    """
    sig, ids = np.empty(0, np.int64), np.empty(0, np.int64)
    large = None
    for batch in batches:
        s = np.concatenate([sig, batch.column("sig").to_numpy()])
        i = np.concatenate([ids, batch.column("id").to_numpy()])
        if not len(s):
            continue
        first = np.concatenate([[True], (s[1:] != s[:-1]) | (i[1:] != i[:-1])])
        s, i = s[first], i[first]
        # The last signature may go on in the next batch.
        cut = len(s) - int((s == s[-1]).sum())
        yield _renamed(s[:cut], i[:cut], large)
        sig, ids = s[cut:], i[cut:]
        if len(sig) > SMALL_BUCKET:
            yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(ids)], names=["sig", "id"])
            large, sig, ids = sig[0], sig[-1:], ids[-1:]
    if len(sig):
        yield _renamed(sig, ids, large)


def _renamed(s: np.ndarray, i: np.ndarray, large: int | None) -> pa.RecordBatch:
    if len(s):
        starts = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        sizes = np.diff(np.append(starts, len(s)))
        name = mix(np.add.reduceat(mix(i.view(np.uint64)), starts) + sizes.astype(np.uint64)).view(np.int64)
        was_large = s[starts] == large if large is not None else np.zeros(len(starts), bool)
        keep = np.repeat((sizes > 1) | was_large, sizes)
        s, i = np.repeat(np.where(was_large, s[starts], name), sizes)[keep], i[keep]
    return pa.RecordBatch.from_arrays([pa.array(s, pa.int64()), pa.array(i, pa.int64())], names=["sig", "id"])


def _buckets(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, components, sizes, bitmaps) of each run of equal (sig, tile)."""
    held: list[tuple] = []
    last = None

    def joined() -> tuple:
        *columns, maps = zip(*held)
        return *(np.concatenate(x) for x in columns), folded([m for part in maps for m in part])

    for batch in batches:
        sig, tile = batch.column("sig").to_numpy(), batch.column("tile").to_numpy()
        if not len(sig):
            continue
        rest = (
            batch.column("id").to_numpy(),
            batch.column("comp").to_numpy(),
            batch.column("n").to_numpy(),
            [m.values.to_numpy() for m in batch.column("map")],
        )
        edges = np.flatnonzero((sig[1:] != sig[:-1]) | (tile[1:] != tile[:-1])) + 1
        cuts = [0, *edges.tolist(), len(sig)]
        for a, b in zip(cuts, cuts[1:]):
            key = (sig[a], tile[a])
            if key != last and held:
                yield joined()
                held = []
            last = key
            held.append(tuple(x[a:b] for x in rest))
    if held:
        yield joined()


def _near(i: int, sizes: np.ndarray, maps: np.ndarray, threshold: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Bit differences of all members to member i, and which of them may link with it."""
    a, b = threshold
    far = np.bitwise_count((maps ^ maps[i]).view(np.uint64)).sum(axis=1, dtype=np.int64)
    may = far <= (b - a) * (sizes + sizes[i]) // (a + b)
    may &= (b * np.minimum(sizes, sizes[i]) >= a * np.maximum(sizes, sizes[i]))
    may[i] = False
    return far, may


def _forest(ids, comps, sizes, maps, threshold) -> list[tuple[int, int]]:
    """Edges of a minimum spanning forest of the candidates among a bucket's members."""
    g = len(ids)
    out: list[tuple[int, int]] = []
    best = np.full(g, 1 << 40, dtype=np.int64)
    parent = np.zeros(g, dtype=np.int64)
    todo = np.ones(g, dtype=bool)
    at = 0
    for _ in range(g):
        todo[at] = False
        far, may = _near(at, sizes, maps, threshold)
        closer = may & todo & (far < best)
        best[closer], parent[closer] = far[closer], at
        if not todo.any():
            break
        at = int(np.argmin(np.where(todo, best, 1 << 41)))
        if best[at] < 1 << 40:
            out.append((int(ids[parent[at]]), int(ids[at])))
    return out


def _crossing(ids, comps, sizes, maps, threshold) -> list[tuple[int, int]]:
    """All candidates whose ends lie in different components."""
    out: list[tuple[int, int]] = []
    for i in range(len(ids)):
        _, may = _near(i, sizes, maps, threshold)
        for j in np.flatnonzero(may & (comps != comps[i]) & (np.arange(len(ids)) > i)):
            out.append((int(ids[i]), int(ids[j])))
    return out


def _candidates(rows: DataFrame, find, threshold: tuple[int, int]) -> DataFrame:
    """Distinct pairs (u, v), u < v, that ``find`` takes from the buckets of ``rows`` (sig, id, comp, n, map)."""
    large = rows.groupBy("sig").count().where(F.col("count") > TILE).select("sig", F.ceil(F.col("count") / TILE).cast("long").alias("tiles"))
    tiled = rows.join(large, "sig", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    own = F.pmod(F.xxhash64("id"), F.col("tiles"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
    tiled = tiled.withColumn("own", own).withColumn("other", other).withColumn(
        "tile", F.least("own", "other") * F.col("tiles") + F.greatest("own", "other")
    )

    def run(batches):
        pairs: list[tuple[int, int]] = []
        for bucket in _buckets(batches):
            if len(bucket[0]) > 1:
                pairs.extend(find(*bucket, threshold))
            if len(pairs) > 50_000:
                yield _pairs(pairs)
                pairs = []
        yield _pairs(pairs)

    dealt = tiled.select("sig", "tile", "id", "comp", "n", "map").repartition("sig", "tile").sortWithinPartitions("sig", "tile", "id")
    return dealt.mapInArrow(freeing(run), "u long, v long").distinct()


def _pairs(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    u, v = [min(p) for p in pairs], [max(p) for p in pairs]
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _verified(pairs: DataFrame, sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """The pairs whose whole sets reach the threshold."""
    a, b = threshold
    both = pairs.join(sets.select(F.col("id").alias("u"), F.col("set").alias("s")), "u").join(
        sets.select(F.col("id").alias("v"), F.col("set").alias("t")), "v"
    )
    common = F.size(F.array_intersect("s", "t")).cast("long")
    return both.where(b * common >= a * (F.size("s") + F.size("t") - common)).select("u", "v")


def _maybe_broadcast(ids: DataFrame) -> DataFrame:
    """A table of ids, sent to every executor if it is small enough."""
    return F.broadcast(ids) if ids.count() * RECORD <= MAX_BROADCAST_BYTES else ids


def link(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: id, n (shingles), class_id (smallest id of an equal set) and component_id.

    ``threshold`` is a fraction (a, b): sets link from a similarity of a / b.
    """
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    profile = land(_profile(texts, shingle), "jaccard-profile")
    one = profile.where("id is not null and n > 0").groupBy("id").agg(F.max(F.struct("n", "high", "low", "map")).alias("p")).select("id", "p.*")
    classes = land(one.groupBy("n", "high", "low").agg(F.min("id").alias("class_id"), F.first("map").alias("map"), F.count("*").alias("rows")), "jaccard-classes")
    copies = land(one.join(classes.where("rows > 1"), ["n", "high", "low"]).where("id <> class_id").select("id", "class_id"), "jaccard-copies")

    signing = texts.where("id is not null")
    few = copies.count() * RECORD <= MAX_BROADCAST_BYTES
    if few:
        signing = signing.join(F.broadcast(copies.select("id")), "id", "left_anti")
    signed = _sign(signing, shingle, threshold)
    shared = signed.repartition("sig").sortWithinPartitions("sig", "id").mapInArrow(freeing(_shared), "sig long, id long")
    if not few:
        shared = shared.join(copies, "id", "left").select("sig", F.coalesce("class_id", "id").alias("id"))
    shared = land(shared.distinct(), "jaccard-shared")

    known = classes.select(F.col("class_id").alias("id"), "n", "map")
    rows = shared.join(known, "id").withColumn("comp", F.col("id"))
    forest = land(_candidates(rows, _forest, threshold), "jaccard-forest")
    ends = land(forest.select(F.explode(F.array("u", "v")).alias("id")).distinct(), "jaccard-ends")

    def build(batches):
        hashes = WordHashes()
        for batch in batches:
            sets = [shingles(t, shingle, hashes) for t in batch.column("text").to_pylist()]
            high = [int(mix(s).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0 for s in sets]
            # Of several texts under one id, the one that stands for it.
            keep = pa.array([h == w for h, w in zip(high, batch.column("high").to_pylist())], pa.bool_())
            made = pa.RecordBatch.from_arrays([batch.column("id"), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["id", "set"])
            yield made.filter(keep)

    wanted = land(ends.join(classes.select(F.col("class_id").alias("id"), "high"), "id"), "jaccard-wanted")
    sets = texts.join(_maybe_broadcast(wanted), "id").mapInArrow(freeing(build), "id long, set array<long>")
    sets = land(sets, "jaccard-sets")
    if sets.groupBy("id").count().where("count > 1").take(1):
        sets = land(sets.dropDuplicates(["id"]), "jaccard-sets")

    links = land(_verified(forest, sets, threshold), "jaccard-links")
    nodes = components(links)
    # What still crosses: signatures with candidates in more than one component.
    rows = shared.join(ends, "id").join(nodes.withColumnRenamed("node", "id"), "id", "left").select("sig", "id", F.coalesce("component", "id").alias("comp"))
    rows = land(rows, "jaccard-nodes")
    split = rows.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("sig")
    crossing = _candidates(rows.join(split, "sig").join(known, "id"), _crossing, threshold).join(forest, ["u", "v"], "left_anti")
    more = land(_verified(land(crossing, "jaccard-crossing"), sets, threshold), "jaccard-more")
    if more.take(1):
        nodes = components(links.unionByName(more))

    found = profile.join(one.select("id", F.col("n").alias("n1"), F.col("high").alias("h1"), F.col("low").alias("l1")), "id", "left")
    found = found.join(
        classes.select(F.col("n").alias("n1"), F.col("high").alias("h1"), F.col("low").alias("l1"), "class_id"), ["n1", "h1", "l1"], "left"
    )
    found = found.join(nodes.select(F.col("node").alias("class_id"), "component"), "class_id", "left")
    return found.select("id", "n", F.coalesce("class_id", "id").alias("class_id"), F.coalesce("component", "class_id", "id").alias("component_id"))
