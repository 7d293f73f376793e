"""SimHash near-duplicates by the generalised pigeonhole principle, exact on fingerprints.

A text's fingerprint has a bit for each of 64: 1 if it is set in over half of
the hashes of the text's word shingles, repeats included. Fingerprints link at
``distance`` or fewer differing bits; documents of equal fingerprints are one
class, which takes part once.

1. Statistics over all classes: how often every two bits are set together, and
   then, for cells of four bits that go together, how often every value occurs.
   Both are sums of tables of fixed size.
2. Correlated cells are grouped into partitions. Thresholds t_1..t_m with
   sum(t_i + 1) = distance + 1 are allotted to them: two linked fingerprints
   differ in at most t_i bits of at least one partition i (-1: it is not looked
   at). Dynamic programming picks the allotment, and a comparison over m the
   partitions, that cost least: probes times a row's cost, and candidates, as
   estimated from the values' counts, times a comparison's cost. So keys get
   longer as the corpus grows.
3. Every class is filed under its value of each partition and probes the values
   within t_i that are greater than its own: of two fingerprints one finds the
   other. What meets under a value is compared as a whole fingerprint, and a
   task emits only as many links as hold its components together.
4. Values with more than ``TILE`` classes are dealt out in tiles, each compared
   alone. Then, where classes of a value still lie in different components,
   those outside the largest one are compared with all others, tile by tile.
   Classes of one component are not compared again, so a large group of near
   copies costs about one look at each of its tiles.

A value shared by very many classes that do not link (texts with a common core
that differ in over ``distance`` bits) costs comparisons in the square of its
tiles, spread over tasks.

Null and empty texts, and texts of white space, have the fingerprint 0 and link
like any other. Texts of fewer words than a shingle have one, of all their
words. Rows of null id have a fingerprint, no component, and link nothing.
Repeated ids count once, by the smallest fingerprint of theirs for links; each
row keeps its own fingerprint. Extra columns are ignored. An empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import LOWER_ASCII, MAX_BROADCAST_BYTES, components, land
from tallyline.llm.jaccard import mix

SHINGLE = 4
DISTANCE = 4
SEED = 42
BITS = 64
CELL = 4
TILE = 1024
#: Seconds of a probe's row and of a comparison, roughly; only their ratio counts.
ROW_COST, PAIR_COST = 2e-6, 4e-9
MAX_PROBE_DISTANCE = 3
RECORD = 24  # bytes of a key in a broadcast table
#: Hashes counted bit by bit, and rows probed, at once.
HASHES, ROWS = 1 << 16, 1 << 14


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of a whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER_ASCII).split()
    if not words:
        return 0
    line = memoryview(b" ".join(words))
    n = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    total = len(words) - n + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts[:total].tolist(), ends[n - 1 :].tolist())), np.uint64, total)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, total, HASHES):
        part = hashes[at : at + HASHES].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Per row: id and fp, the fingerprint as a signed long."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                fps = np.array([fingerprint(t, shingle) for t in piece.column("text").to_pylist()], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([piece.column("id"), pa.array(fps.view(np.int64))], names=["id", "fp"])

    own = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return own.mapInArrow(run, "id long, fp long")


def bits_of(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _summed(classes: DataFrame, table, shape: tuple[int, ...]) -> np.ndarray:
    """The sum over all classes of a table of fixed size that ``table`` makes of an array of fingerprints."""

    def run(batches):
        total = np.zeros(shape, dtype=np.int64)
        for batch in batches:
            total += table(batch.column("fp").to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["at", "n"])

    out = np.zeros(shape, dtype=np.int64)
    for r in classes.select("fp").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out.ravel()[r["at"]] = r["n"]
    return out


def together(fps: np.ndarray) -> np.ndarray:
    """How often every two bits are set together."""
    out = np.zeros((BITS, BITS), dtype=np.int64)
    for at in range(0, len(fps), ROWS):
        x = bits_of(fps[at : at + ROWS]).astype(np.float32)  # sums below 2^24 are exact
        out += (x.T @ x).astype(np.int64)
    return out


def bit_cells(both: np.ndarray, n: int) -> list[list[int]]:
    """The bits in cells of correlated ones, neighbouring cells correlated too."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    linked = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(linked, 0)
    free, out, drawn = set(range(BITS)), [], np.zeros(BITS)
    while free:
        cell: list[int] = []
        while len(cell) < CELL:
            # The bit closest to the cell so far, and to the cells before it.
            near = linked[:, cell].sum(axis=1) if cell else drawn if out else linked.sum(axis=1)
            cell.append(min(free, key=lambda b: (-near[b], b)))
            free.discard(cell[-1])
        out.append(cell)
        drawn = drawn / 2 + linked[:, cell].sum(axis=1)
    return out


def values_of(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """The value of some bits, the first of them lowest."""
    out = np.zeros(len(fps), dtype=np.int64)
    for k, b in enumerate(bits):
        out |= ((fps >> b) & 1) << k
    return out


def cell_counts(cells: list[list[int]]):
    def table(fps: np.ndarray) -> np.ndarray:
        return np.stack([np.bincount(values_of(fps, c), minlength=1 << CELL) for c in cells])

    return table


def distances(counts: np.ndarray) -> np.ndarray:
    """How far two random members of a cell lie apart: probabilities of 0..CELL bits."""
    p = counts / max(counts.sum(), 1)
    v = np.arange(1 << CELL)
    apart = np.bitwise_count(v[:, None] ^ v[None, :])
    return np.bincount(apart.ravel(), np.outer(p, p).ravel(), CELL + 1)


@dataclass(frozen=True)
class Plan:
    """Partitions of the bits, and the threshold of each."""

    partitions: tuple[tuple[int, ...], ...]
    thresholds: tuple[int, ...]
    cost: float


def plan(cells: list[list[int]], counts: np.ndarray, n: int, distance: int = DISTANCE) -> Plan:
    """The cheapest partitions and thresholds for n fingerprints."""
    best = None
    for m in range(1, min(distance + 1, len(cells)) + 1):
        cuts = [round(k * len(cells) / m) for k in range(m + 1)]
        partitions = [tuple(b for c in cells[s:e] for b in c) for s, e in zip(cuts, cuts[1:])]
        costs = []
        for bits, s, e in zip(partitions, cuts, cuts[1:]):
            apart = np.ones(1)
            for c in range(s, e):
                apart = np.convolve(apart, distances(counts[c]))
            own = [0.0]
            for t in range(distance + 1):
                # Half of the values around a class's own are greater.
                rows = 1 + sum(comb(len(bits), d) for d in range(1, t + 1)) / 2
                own.append(n * rows * ROW_COST + n * n / 2 * apart[: t + 1].sum() * PAIR_COST if t <= MAX_PROBE_DISTANCE else np.inf)
            costs.append(own)
        # least[r]: the least cost of the partitions so far that use up r of distance + 1, and how.
        least = {0: (0.0, ())}
        for own in costs:
            step: dict[int, tuple[float, tuple]] = {}
            for used, (cost, how) in least.items():
                for more, extra in enumerate(own):
                    if used + more <= distance + 1:
                        now = (cost + extra, (*how, more - 1))
                        if used + more not in step or now < step[used + more]:
                            step[used + more] = now
            least = step
        cost, how = least[distance + 1]
        if best is None or cost < best.cost:
            best = Plan(tuple(partitions), how, cost)
    return best


def probes(fps: np.ndarray, chosen: Plan) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, keys, whether a row is filed there) for all partitions that are looked at.

    A key is a mix of a partition's number and the value; should two agree, more is compared, and nothing is lost.
    """
    everyone = np.arange(len(fps))
    for k, (bits, t) in enumerate(zip(chosen.partitions, chosen.thresholds)):
        if t < 0:
            continue
        own = values_of(fps, list(bits)).view(np.uint64)
        key = lambda v: mix(v + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % 2**64)).view(np.int64)  # noqa: B023, E731
        yield everyone, key(own), np.ones(len(fps), dtype=bool)
        for d in range(1, t + 1):
            for flip in combinations(range(len(bits)), d):
                # Greater values only: the highest bit that changes is 0.
                at = np.flatnonzero((own >> np.uint64(flip[-1])) & np.uint64(1) == 0)
                yield at, key(own[at] ^ np.uint64(sum(1 << b for b in flip))), np.zeros(len(at), dtype=bool)


def _keyed(classes: DataFrame, chosen: Plan) -> DataFrame:
    """key, filed, id, fp: every class under its own values and the values it probes."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                piece = batch.slice(at, ROWS)
                ids, fps = piece.column("id").to_numpy(), piece.column("fp").to_numpy()
                for rows, keys, filed in probes(fps, chosen):
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(filed), pa.array(ids[rows]), pa.array(fps[rows])], names=["key", "filed", "id", "fp"])

    return classes.select("id", "fp").mapInArrow(run, "key long, filed boolean, id long, fp long")


def links(ids: np.ndarray, fps: np.ndarray, filed: np.ndarray, comps: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that hold the same components together as all links between different components with a filed end do.

    What a member is found to link with joins its component here and is not
    compared with further members of it.
    """
    out = []
    n = len(ids)
    if n < 2 or not filed.any():
        return out
    if n <= TILE and (comps == ids).all():
        # Few members: all at once.
        left = np.flatnonzero(filed)
        near = np.bitwise_count(fps[left, None] ^ fps[None, :]) <= distance
        u, v = np.nonzero(near)
        u = left[u]
        keep = u != v
        if keep.sum() <= 4 * n:
            return [(ids[u[keep]], ids[v[keep]])] if keep.any() else out
    # Breadth first, over components: members of the component at hand are dropped from what is left.
    left = np.argsort(comps, kind="stable")
    while len(left):
        comp = comps[left[0]]
        queue = left[comps[left] == comp].tolist()
        left = left[comps[left] != comp]
        while queue and len(left):
            at = queue.pop()
            others = left if filed[at] else left[filed[left]]
            hit = others[np.bitwise_count(fps[others] ^ fps[at]) <= distance]
            if len(hit):
                # One link to each component, then its members follow.
                found, first = np.unique(comps[hit], return_index=True)
                out.append((np.full(len(found), ids[at]), ids[hit[first]]))
                joined = np.isin(comps[left], found)
                queue.extend(left[joined].tolist())
                left = left[~joined]
    return out


def _compare(dealt: DataFrame, distance: int) -> DataFrame:
    """Links (u, v) within each run of equal (key, tile); rows come with key, tile, filed, id, fp, comp."""

    def run(batches):
        for held in _runs(batches):
            found = links(*held, distance)
            if found:
                u, v = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["u", "v"])

    rows = dealt.select("key", "tile", "filed", "id", "fp", "comp").repartition("key", "tile").sortWithinPartitions("key", "tile")
    return rows.mapInArrow(run, "u long, v long")


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, fps, filed, comps) of each run of equal (key, tile) with more than one member."""
    last, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        key, tile = batch.column("key").to_numpy(), batch.column("tile").to_numpy()
        # Unsigned: of a signed number the bits of its absolute value would be counted.
        rest = [batch.column("id").to_numpy(), batch.column("fp").to_numpy().view(np.uint64), batch.column("filed").to_numpy(zero_copy_only=False), batch.column("comp").to_numpy()]
        cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]) | (tile[1:] != tile[:-1])) + 1).tolist(), len(key)]
        for s, e in zip(cuts, cuts[1:]):
            now = (key[s], tile[s])
            if now != last and held:
                if sum(len(x[0]) for x in held) > 1:
                    yield tuple(np.concatenate(x) for x in zip(*held))
                held = []
            last = now
            held.append([x[s:e] for x in rest])
    if held and sum(len(x[0]) for x in held) > 1:
        yield tuple(np.concatenate(x) for x in zip(*held))


def _maybe_broadcast(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if keys.count() * RECORD <= MAX_BROADCAST_BYTES else keys


def _within_tiles(keyed: DataFrame, large: DataFrame, distance: int) -> DataFrame:
    """Links within each value, or within each tile of a value of many classes."""
    tiled = keyed.join(_maybe_broadcast(large), "key", "left").select(
        *keyed.columns, F.col("id").alias("comp"), F.when(F.col("tiles").isNull(), 0).otherwise(F.pmod(F.xxhash64("id"), "tiles")).alias("tile")
    )
    return _compare(tiled, distance)


def _across_tiles(keyed: DataFrame, large: DataFrame, nodes: DataFrame, distance: int) -> DataFrame:
    """Links between different components among the classes of a large value.

    Classes outside the value's largest component lie in the first tiles, the
    ``few``; a pair of tiles is looked at if one of them is among those.
    """
    rows = keyed.join(_maybe_broadcast(large.select("key")), "key").join(nodes.withColumnRenamed("node", "id"), "id", "left")
    rows = land(rows.select("key", "filed", "id", "fp", F.coalesce("component", "id").alias("comp")), "simhash-large")
    sizes = rows.groupBy("key", "comp").count()
    most = sizes.groupBy("key").agg(F.max(F.struct("count", "comp")).alias("m"), F.sum("count").alias("all")).select(
        "key", F.col("m.comp").alias("main"), F.ceil((F.col("all") - F.col("m.count")) / TILE).cast("long").alias("few"), F.ceil(F.col("m.count") / TILE).cast("long").alias("many")
    )
    open_keys = land(most.where("few > 0"), "simhash-open")
    split = rows.join(_maybe_broadcast(open_keys), "key")
    spread = F.xxhash64("id", F.lit(1))
    total = F.col("few") + F.col("many")
    inside = F.col("comp") != F.col("main")
    split = split.withColumn("own", F.when(inside, F.pmod(spread, "few")).otherwise(F.col("few") + F.pmod(spread, "many")))
    upto = F.when(inside, total).otherwise(F.col("few"))
    split = split.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), upto - 1)))
    tile = F.least("own", "other") * total + F.greatest("own", "other")
    return _compare(split.select("key", "filed", "id", "fp", "comp", tile.alias("tile")), distance)


def link(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """Per row: id, fp (signed), class_id (smallest id of an equal fingerprint) and component_id."""
    return link_fingerprints(land(fingerprints(docs, key, text, shingle), "simhash-rows"), distance)


def link_fingerprints(rows: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """The same for rows of id and fp."""
    one = rows.where("id is not null").groupBy("id").agg(F.min("fp").alias("fp"))
    classes = land(one.groupBy("fp").agg(F.min("id").alias("id")), "simhash-classes")
    n = classes.count()
    cells = bit_cells(_summed(classes, together, (BITS, BITS)), n)
    chosen = plan(cells, _summed(classes, cell_counts(cells), (BITS // CELL, 1 << CELL)), n, distance)

    keyed = _keyed(classes, chosen)
    large = land(
        keyed.groupBy("key").count().where(F.col("count") > TILE).select("key", F.ceil(F.col("count") / (TILE // 2)).cast("long").alias("tiles")),
        "simhash-values",
    )
    found = land(_within_tiles(keyed, large, distance).distinct(), "simhash-links")
    nodes = land(components(found), "simhash-nodes")
    if large.take(1):
        more = land(_across_tiles(keyed, large, nodes, distance).distinct(), "simhash-more")
        if more.take(1):
            nodes = land(components(found.unionByName(more)), "simhash-nodes")

    known = classes.withColumnRenamed("id", "class_id").join(nodes.withColumnRenamed("node", "class_id"), "class_id", "left")
    known = one.join(known, "fp").select("id", "class_id", F.coalesce("component", "class_id").alias("component_id"))
    return rows.join(known, "id", "left").select("id", "fp", "class_id", "component_id")
