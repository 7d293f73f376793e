"""Approximate nearest neighbours by learned partitions.

A bounded sample of vectors gives a neighbour graph, which is cut into parts of
equal size with few edges between them. A small neural classifier learns to tell
from a vector in which parts its neighbours lie. Every vector is indexed under
its most probable part; a query is routed to several most probable ones and
reranked there by exact cosine. How many are probed is at least the number that
reaches a target recall, measured on CALIBRATE of the real queries (all, if there
are fewer) against exact search over the whole index.

Only the model (its size is set by parameters, not by data) is broadcast. Parts
are cut into blocks and their queries into chunks of bounded size, so a part that
holds a third of all rows is so many tiles more; each tile returns its best few
per query, and these are merged.

Null, zero, null-holding and non-finite vectors take no part, nor do vectors of
a length other than the most common one, or null ids. Ties go to the smaller id.
Rows that repeat an id are candidates of their own, but never for a query of
that id; of several query rows of one id the least vector asks. Extra columns
are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.common import key_bits, land

SAMPLE = 8192
GRAPH_NEIGHBOURS = 10
ROWS_PER_PART = 500
MAX_PARTS = 128
HIDDEN = 128
EPOCHS = 40
BATCH = 256
TARGET_RECALL = 0.95
#: Queries that are searched exactly.
CALIBRATE = 512
BLOCK_ROWS = 4096
CHUNK_QUERIES = 1024
#: Products that are this close are compared by the exact measure.
SLACK = 1e-9


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest others of each row of unit vectors, a block of rows at a time."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), max(k, 0)), dtype=np.int64)
    for at in range(0, len(x), 1024):
        near = x[at : at + 1024] @ x.T
        rows = np.arange(len(near))
        near[rows, at + rows] = -np.inf
        out[at : at + 1024] = np.argpartition(-near, max(k - 1, 0), axis=1)[:, :k]
    return out


def balanced_parts(graph: np.ndarray, parts: int, rounds: int = 20) -> np.ndarray:
    """Cut a neighbour graph into parts of equal size (5 % more at most).

    Parts grow one after another, always by the free node with the most edges
    into the part; then nodes move to the part that most of their neighbours
    are in, as long as there is room.
    """
    n = len(graph)
    links: list[list[int]] = [[] for _ in range(n)]
    for i, row in enumerate(graph.tolist()):
        for j in row:
            links[i].append(j)
            links[j].append(i)
    room = -(-n // parts)
    part = np.full(n, -1, dtype=np.int64)
    free, seed = n, 0
    for p in range(parts):
        size, pull = 0, {}
        goal = -(-free // (parts - p))
        while size < goal and free:
            if pull:
                at = max(pull, key=lambda i: (pull[i], -i))
                del pull[at]
            else:
                while part[seed] >= 0:
                    seed += 1
                at = seed
            part[at] = p
            size, free = size + 1, free - 1
            for j in links[at]:
                if part[j] < 0:
                    pull[j] = pull.get(j, 0) + 1
    sizes = np.bincount(part, minlength=parts)
    most, least = int(room * 1.05) + 1, int(room * 0.85)
    for _ in range(rounds):
        moved = 0
        for i in range(n):
            votes = np.bincount(part[links[i]], minlength=parts) if links[i] else None
            if votes is None:
                continue
            votes[sizes >= most] = -1
            votes[part[i]] = (part[links[i]] == part[i]).sum()
            to = int(votes.argmax())
            if votes[to] > votes[part[i]] and sizes[part[i]] > least:
                sizes[part[i]] -= 1
                sizes[to] += 1
                part[i] = to
                moved += 1
        if moved < n // 200:
            break
    return part


class Router:
    """One hidden layer from a unit vector to the probabilities of the parts."""

    def __init__(self, weights: list[np.ndarray]):
        self.weights = weights

    @classmethod
    def fit(cls, x: np.ndarray, target: np.ndarray, seed: int = 7) -> Router:
        rng = np.random.default_rng(seed)
        d, k = x.shape[1], target.shape[1]
        w = [rng.normal(0, np.sqrt(2 / d), (d, HIDDEN)) * np.sqrt(d), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, k)), np.zeros(k)]
        m, v, step = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
        for epoch in range(EPOCHS):
            order = rng.permutation(len(x))
            rate = 0.003 * (1 - epoch / EPOCHS) + 1e-4
            for at in range(0, len(x), BATCH):
                rows = order[at : at + BATCH]
                hidden = np.maximum(x[rows] @ w[0] + w[1], 0)
                z = hidden @ w[2] + w[3]
                p = np.exp(z - z.max(axis=1, keepdims=True))
                error = (p / p.sum(axis=1, keepdims=True) - target[rows]) / len(rows)
                back = (error @ w[2].T) * (hidden > 0)
                grads = [x[rows].T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
                step += 1
                for a, g, m1, v1 in zip(w, grads, m, v):
                    m1 += 0.1 * (g - m1)
                    v1 += 0.001 * (g * g - v1)
                    a -= rate * (m1 / (1 - 0.9**step)) / (np.sqrt(v1 / (1 - 0.999**step)) + 1e-8)
        return cls(w)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.weights[0] + self.weights[1], 0) @ self.weights[2] + self.weights[3]


class LearnedPartitions:
    """Router, number of parts, and how many of them a query probes."""

    def __init__(self, router: Router | None, parts: int, probes: int):
        self.router, self.parts, self.probes = router, parts, probes

    @classmethod
    def fit(cls, vectors: np.ndarray, parts: int, target_recall: float = TARGET_RECALL, k: int = 5) -> LearnedPartitions:
        if parts < 2 or len(vectors) < 4 * parts:
            return cls(None, 1, 1)
        # Equal vectors would only be each other's neighbours.
        x = np.unique(unit(vectors), axis=0)
        x = x[np.random.default_rng(11).permutation(len(x))]
        if len(x) < 4 * parts:
            return cls(None, 1, 1)
        graph = neighbour_graph(x, GRAPH_NEIGHBOURS)
        part = balanced_parts(graph, parts)
        target = np.zeros((len(x), parts))
        np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1.0)
        target[np.arange(len(x)), part] += 1.0
        router = Router.fit(x, target / target.sum(axis=1, keepdims=True))
        scores = router.scores(x)
        home = scores.argmax(axis=1)
        # How deep down a query's list of parts its true neighbours are.
        asked = np.arange(len(x))[:1024]
        depth = np.argsort(np.argsort(-scores[asked], axis=1), axis=1)
        near = neighbour_graph(x, k)[asked]
        ranks = np.take_along_axis(depth, home[near], axis=1).ravel()
        reach = np.cumsum(np.bincount(ranks, minlength=parts)) / len(ranks)
        return cls(router, parts, int(np.searchsorted(reach, target_recall)) + 1)

    def home(self, x: np.ndarray) -> np.ndarray:
        return self.route(x, 1)[:, 0]

    def route(self, x: np.ndarray, probes: int | None = None) -> np.ndarray:
        """The most probable parts of each vector, most probable first."""
        probes = min(probes or self.probes, self.parts)
        if self.router is None:
            return np.zeros((len(x), 1), dtype=np.int64)
        return np.argsort(-self.router.scores(unit(x)), axis=1, kind="stable")[:, :probes]


def matrix(column) -> np.ndarray:
    """An Arrow column of equally long lists as rows of doubles."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vector) of the rows that can be compared."""
    own = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")).where(
        F.col("id").isNotNull() & F.col("vector").isNotNull()
    )
    odd = F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    own = own.where(~odd & F.exists("vector", lambda v: v != 0))
    size = own.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return own.where(F.size("vector") == (size["size"] if size else 0))


def _best(index: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int) -> tuple[list, list, list]:
    """Each query's k nearest in a tile, by exact cosine, ties by id."""
    out: tuple[list, list, list] = ([], [], [])
    lengths = np.sqrt((index * index).sum(axis=1))
    near = (queries @ index.T) / lengths / np.sqrt((queries * queries).sum(axis=1))[:, None]
    near[query_ids[:, None] == ids[None, :]] = -np.inf
    for q in range(len(queries)):
        row = near[q]
        at = np.flatnonzero(row > -np.inf)
        if len(at) > k:
            at = np.flatnonzero(row >= np.partition(row, len(row) - k)[len(row) - k] - SLACK)
        # Sums along a row do not depend on where the row is: equal vectors tie exactly.
        exact = (index[at] * queries[q]).sum(axis=1) / (lengths[at] * np.sqrt((queries[q] * queries[q]).sum()))
        order = np.lexsort((ids[at], -exact))[:k]
        out[0].extend([int(query_ids[q])] * len(order))
        out[1].extend(ids[at[order]].tolist())
        out[2].extend(exact[order].tolist())
    return out


def measured_probes(model: LearnedPartitions, index: DataFrame, asked: DataFrame, k: int, target_recall: float = TARGET_RECALL) -> int:
    """The least number of parts with which the target share of the sample queries' true neighbours in ``index`` are found."""
    sample = asked.orderBy(key_bits(F.col("id")), "id").limit(CALIBRATE).select("id", "vector").toArrow()
    if model.router is None or not sample.num_rows:
        return model.probes
    queries, query_ids = matrix(sample.column("vector")), sample.column("id").to_numpy()
    shared = index.sparkSession.sparkContext.broadcast((queries, query_ids))

    def exact(batches):
        queries, query_ids = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, part = batch.column("id").to_numpy(), batch.column("part").to_numpy()
            order = np.argsort(ids, kind="stable")
            found = _best(matrix(batch.column("vector")), ids, queries, query_ids, k)
            at = order[np.searchsorted(ids[order], np.array(found[1], dtype=np.int64))]
            columns = [pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.float64()), pa.array(part[at], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score", "part"])

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    near = index.select("part", "id", "vector").mapInArrow(exact, "query_id long, vec_id long, score double, part long")
    near = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "part").toArrow()
    if not near.num_rows:
        return model.probes
    depth = np.argsort(model.route(queries, model.parts), axis=1)
    by_id = np.argsort(query_ids)
    query = by_id[np.searchsorted(query_ids[by_id], near.column("query_id").to_numpy())]
    ranks = depth[query, near.column("part").to_numpy()]
    reach = np.cumsum(np.bincount(ranks, minlength=model.parts)) / len(ranks)
    return max(model.probes, int(np.searchsorted(reach, target_recall)) + 1)


def search(df: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 5, probes: int | None = None) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k nearest found; ``is_query`` is a condition on ``id``."""
    rows = land(usable(df, key, vector), "ann-rows")
    total = rows.count()
    # About a tenth too many by hash, then the first SAMPLE of them: an order over all rows would
    # send as many from every task.
    share = min(1.0, 1.1 * SAMPLE / max(total, 1))
    drawn = land(rows.where(key_bits(F.col("id")) <= int(share * ((1 << 60) - 1))), "ann-sample")
    sample = drawn.orderBy(key_bits(F.col("id")), "id").limit(SAMPLE).select("vector").toArrow()
    vectors = matrix(sample.column("vector")) if sample.num_rows else np.zeros((0, 1))
    model = LearnedPartitions.fit(vectors, max(1, min(MAX_PARTS, total // ROWS_PER_PART)), k=k)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def place(batches):
        for batch in batches:
            x = matrix(batch.column("vector"))
            part = shared.value.home(x) if len(x) else np.empty(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), *batch.columns], names=["part", "id", "vector"])

    def probe(batches):
        for batch in batches:
            x = matrix(batch.column("vector"))
            parts = shared.value.route(x, probes) if len(x) else np.empty((0, 1), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(list(parts), pa.list_(pa.int64())), *batch.columns], names=["parts", "id", "vector"])

    index = land(rows.mapInArrow(place, "part long, id long, vector array<double>"), "ann-index")
    asked = rows.where(is_query).groupBy("id").agg(F.min("vector").alias("vector"))
    probes = probes or measured_probes(model, index, asked, k)
    asked = asked.mapInArrow(probe, "parts array<long>, id long, vector array<double>").select(F.explode("parts").alias("part"), "id", "vector")
    asked = land(asked, "ann-asked")
    # One row per part: at most MAX_PARTS.
    blocks = index.groupBy("part").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("long").alias("blocks"))
    chunks = asked.groupBy("part").agg(F.ceil(F.count("*") / CHUNK_QUERIES).cast("long").alias("chunks"))
    tiles = F.broadcast(land(blocks.join(chunks, "part"), "ann-tiles"))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = index.join(tiles, "part").select("part", F.pmod(F.xxhash64("id"), "blocks").alias("block"), upto("chunks").alias("chunk"), "id", "vector")
    right = asked.join(tiles, "part").select("part", upto("blocks").alias("block"), F.pmod(F.xxhash64("id"), "chunks").alias("chunk"), "id", "vector")

    def rerank(a: pa.Table, b: pa.Table) -> pa.Table:
        found: tuple[list, list, list] = ([], [], [])
        if a.num_rows and b.num_rows:
            found = _best(matrix(a.column("vector")), a.column("id").to_numpy(), matrix(b.column("vector")), b.column("id").to_numpy(), k)
        return pa.table([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.float64())], names=["query_id", "vec_id", "score"])

    tile = ("part", "block", "chunk")
    best = left.groupBy(*tile).cogroup(right.groupBy(*tile)).applyInArrow(rerank, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
