"""Approximate nearest neighbours by a robust-pruned directed graph per shard.

Every distinct vector is a node of one shard's graph. A graph is built in batches: greedy
beam searches from the middle propose neighbours, relaxed pruning keeps a candidate only
if no kept neighbour is nearer to it by the factor ``alpha``, and edges are given back.
Queries go through the graph of every shard, in blocks. Largest inner products become
smallest distances by one more component that brings all vectors to one length. So that
this component does not drown the others, only vectors of like length share a shard.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rushcart.sources.folders import stored

#: Vectors of a shard, about; the task that builds it holds them all.
SHARD_ROWS = 8_192
#: Queries that meet a shard in one task.
QUERY_BLOCK = 4_096
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 100
ALPHA = 1.2
BATCH = 256


class Graph:
    """Vectors of one shard and their out-edges, -1 where a node has fewer than DEGREE."""

    def __init__(self, vectors: np.ndarray, edges: np.ndarray | None = None):
        self.vectors = vectors
        lengths = (vectors.astype(np.float64) ** 2).sum(axis=1)
        rest = np.sqrt(np.maximum(lengths.max() - lengths, 0)) if len(vectors) else lengths
        self.points = np.concatenate([vectors, rest[:, None]], axis=1, dtype=np.float64)
        self.lengths = (self.points**2).sum(axis=1)
        middle = self.points.mean(axis=0) if len(vectors) else 0
        self.start = int(((self.points - middle) ** 2).sum(axis=1).argmin()) if len(vectors) else 0
        self.edges = edges

    def distances(self, queries: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """From each query (rows) to its nodes, up to the query's own length; -1 nodes are infinitely far."""
        near = self.lengths[nodes] - 2 * np.matmul(self.points[nodes], queries[:, :, None])[:, :, 0]
        return np.where(nodes < 0, np.inf, near)

    def beam(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """The ``width`` nearest nodes found for each query, their distances, and all nodes expanded on the way."""
        lanes = np.arange(len(queries))
        nodes = np.full((len(queries), width), -1, np.int64)
        far = np.full((len(queries), width), np.inf)
        done = np.ones((len(queries), width), bool)
        nodes[:, 0], done[:, 0] = self.start, False
        far[:, 0] = self.distances(queries, nodes[:, :1])[:, 0]
        seen = np.zeros((len(queries), len(self.points)), bool)
        seen[:, self.start] = True
        path = []
        while True:
            next_ = np.where(done, np.inf, far).argmin(axis=1)
            going = ~done[lanes, next_]
            if not going.any():
                return nodes, far, path
            live = lanes[going]
            done[live, next_[going]] = True
            at = np.full(len(queries), -1, np.int64)
            at[live] = nodes[live, next_[going]]
            path.append(at)
            found = self.edges[at[live]]
            fresh = (found >= 0) & ~seen[live[:, None], found]
            found = np.where(fresh, found, -1)
            row, column = np.nonzero(fresh)
            seen[live[row], found[row, column]] = True
            both = np.concatenate([nodes[live], found], axis=1)
            both_far = np.concatenate([far[live], self.distances(queries[live], found)], axis=1)
            both_done = np.concatenate([done[live], found < 0], axis=1)
            best = np.argsort(both_far, axis=1, kind="stable")[:, :width]
            side = np.arange(len(live))[:, None]
            nodes[live], far[live], done[live] = both[side, best], both_far[side, best], both_done[side, best]

    def prune(self, owners: np.ndarray, candidates: np.ndarray, alpha: float) -> np.ndarray:
        """Of each owner's candidates (rows, -1 for none), at most DEGREE: the nearest first, each
        dropping the others that are nearer to it, times ``alpha``, than to the owner."""
        candidates = np.sort(candidates, axis=1)
        candidates[candidates == owners[:, None]] = -1
        candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
        own = self.points[owners]
        whole = self.distances(own, candidates) + self.lengths[owners][:, None]
        away = whole.copy()
        lanes, out = np.arange(len(owners)), np.full((len(owners), DEGREE), -1, np.int64)
        around = self.points[candidates]
        for k in range(DEGREE):
            best = away.argmin(axis=1)
            real = np.isfinite(away[lanes, best])
            if not real.any():
                break
            chosen = candidates[lanes, best]
            out[real, k] = chosen[real]
            to_chosen = self.lengths[candidates] - 2 * np.matmul(around, self.points[chosen][:, :, None])[:, :, 0] + self.lengths[chosen][:, None]
            away[(alpha**2 * to_chosen <= whole) & real[:, None]] = np.inf
            away[lanes, best] = np.inf
        return out

    def build(self, seed: int) -> None:
        n = len(self.points)
        rng = np.random.default_rng(seed)
        self.edges = np.full((n, DEGREE), -1, np.int64)
        if n <= 1:
            return
        random = rng.integers(0, n, (n, DEGREE // 2))
        self.edges[:, : DEGREE // 2] = np.where(random == np.arange(n)[:, None], -1, random)
        for alpha in (1.0, ALPHA):
            order = rng.permutation(n)
            for a in range(0, n, BATCH):
                own = order[a : a + BATCH]
                nodes, _, path = self.beam(self.points[own], BUILD_BEAM)
                seen = np.stack(path, axis=1)[:, -2 * BUILD_BEAM :]
                self.edges[own] = self.prune(own, np.concatenate([nodes, seen, self.edges[own]], axis=1), alpha)
                self._give_back(own, alpha)

    def _give_back(self, own: np.ndarray, alpha: float) -> None:
        """Adds the edges of ``own`` in the other direction; nodes that get too many are pruned."""
        to = self.edges[own]
        source, target = np.repeat(own, DEGREE)[to.ravel() >= 0], to.ravel()[to.ravel() >= 0]
        present = (self.edges[target] == source[:, None]).any(axis=1)
        source, target = source[~present], target[~present]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        if not len(target):
            return
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        place = np.arange(len(target)) - np.repeat(first, count)
        more = np.full((len(nodes), int(count.max())), -1, np.int64)
        more[np.repeat(np.arange(len(nodes)), count), place] = source
        both = np.concatenate([self.edges[nodes], more], axis=1)
        fits = (both >= 0).sum(axis=1) <= DEGREE
        packed = np.take_along_axis(both[fits], np.argsort(both[fits] < 0, axis=1, kind="stable"), axis=1)
        self.edges[nodes[fits]] = packed[:, :DEGREE]
        for a in range(0, len(nodes), BATCH):
            over = np.flatnonzero(~fits[a : a + BATCH]) + a
            if len(over):
                self.edges[nodes[over]] = self.prune(nodes[over], both[over], alpha)

    def search(self, queries: np.ndarray, width: int) -> np.ndarray:
        """Nodes found for each query, nearest first, -1 for none."""
        still = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1, dtype=np.float64)
        found = [self.beam(still[a : a + BATCH], width)[0] for a in range(0, len(still), BATCH)]
        return np.concatenate(found) if found else np.zeros((0, width), np.int64)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part, every pair once."""
    x = F.col("embedding").cast("array<double>")
    whole = F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
    nonzero = F.coalesce(F.exists(x, lambda v: v != 0), F.lit(False))
    return vectors.where(whole & nonzero & F.col("vec_id").isNotNull()).select("vec_id", x.alias("embedding")).distinct()


def _graphs(seed: int):
    """From nodes in the order of their shard, one row per node with its edges."""

    def built(rows):
        vectors = np.array([r["embedding"] for r in rows], np.float64)
        graph = Graph(vectors)
        graph.build(seed + rows[0]["shard"])
        return pa.RecordBatch.from_pylist(
            [{"shard": r["shard"], "node": i, "embedding": r["embedding"], "ids": r["ids"], "edges": e[e >= 0].tolist()} for i, (r, e) in enumerate(zip(rows, graph.edges))],
            _INDEX,
        )

    def run(batches):
        rows = []
        for batch in batches:
            for row in batch.to_pylist():
                if rows and row["shard"] != rows[0]["shard"]:
                    yield built(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield built(rows)

    return run


INDEX = "shard long, node long, embedding array<double>, ids array<long>, edges array<long>"
_INDEX = pa.schema(
    [
        ("shard", pa.int64()),
        ("node", pa.int64()),
        ("embedding", pa.list_(pa.float64())),
        ("ids", pa.list_(pa.int64())),
        ("edges", pa.list_(pa.int64())),
    ]
)


def build_index(vectors: DataFrame, k: int = 20, shard_rows: int = SHARD_ROWS, seed: int = 0) -> DataFrame:
    """The graphs of all shards: (shard, node, embedding, ids, edges), one row per distinct vector.

    Of the ids of equal vectors the ``k + 1`` smallest are kept. They all are equally near to
    anything and ties go to the smaller id, so no other one can be among the ``k`` nearest.
    The vectors of a shard have one number of components and lengths that differ by less than a
    factor of four; a hash deals those alike into shards of about ``shard_rows``.
    """
    turn = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    few = usable(vectors).withColumn("turn", turn).where(F.col("turn") <= k + 1)
    square = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    alike = F.struct(F.size("embedding").alias("dims"), F.coalesce(F.floor(F.log2(square) / 4), F.lit(-9999)).alias("length"))
    nodes = few.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("alike", alike)
    nodes = stored(nodes, "nodes")
    # a row for each number of components and factor of four, of which doubles have 1,050
    kinds = nodes.groupBy("alike").agg(F.ceil(F.count("*") / shard_rows).alias("shards"))
    upto = Window.orderBy("alike").rowsBetween(Window.unboundedPreceding, -1)
    kinds = stored(kinds.select("alike", "shards", F.coalesce(F.sum("shards").over(upto), F.lit(0)).alias("first")), "kinds")
    shards = kinds.agg(F.sum("shards")).first()[0] or 1
    dealt = nodes.join(kinds, "alike").withColumn("shard", F.col("first") + F.pmod(F.xxhash64("embedding"), F.col("shards")))
    dealt = dealt.repartitionById(shards, F.col("shard").cast("int"))
    ordered = dealt.sortWithinPartitions("shard", F.element_at("ids", 1)).select("shard", "embedding", "ids")
    return stored(ordered.mapInArrow(_graphs(seed), INDEX), "index")


def _answers(k: int, width: int):
    """From (shard, block, kind, ...) in order: nodes of a shard, then the queries that meet it."""

    def run(batches):
        now, nodes, graph, ids, queries = None, [], None, None, []

        def flush():
            nonlocal graph, ids
            if graph is None and nodes:
                vectors = np.array([r["embedding"] for r in nodes], np.float64)
                edges = np.full((len(nodes), DEGREE), -1, np.int64)
                for i, r in enumerate(nodes):
                    edges[i, : len(r["edges"])] = r["edges"]
                graph, ids = Graph(vectors, edges), [r["ids"] for r in nodes]
                nodes.clear()
            if graph is None or not queries:
                queries.clear()
                return None
            asked = np.array([q["embedding"] for q in queries], np.float64)
            out = []
            for query, vector, found in zip(queries, asked, graph.search(asked, max(width, k))):
                found = found[found >= 0]
                score = (graph.vectors[found] * vector).sum(axis=1)
                best = sorted(
                    (-s, i) for s, n in zip(score.tolist(), found.tolist()) for i in ids[n] if i != query["vec_id"]
                )[:k]
                out += [{"query_id": query["vec_id"], "embedding_key": query["key"], "vec_id": i, "score": -s} for s, i in best]
            queries.clear()
            return pa.RecordBatch.from_pylist(out, _ANSWER)

        for batch in batches:
            for row in batch.to_pylist():
                if (row["shard"], row["block"]) != now:
                    if (found := flush()) is not None:
                        yield found
                    now, graph = (row["shard"], row["block"]), None
                    nodes.clear()
                if row["kind"] == 0:
                    nodes.append(row)
                else:
                    queries.append(row)
                    if len(queries) >= BATCH:
                        if (found := flush()) is not None:
                            yield found
        if (found := flush()) is not None:
            yield found

    return run


ANSWERS = "query_id long, embedding_key long, vec_id long, score double"
_ANSWER = pa.schema([("query_id", pa.int64()), ("embedding_key", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def nearest(index: DataFrame, queries: DataFrame, k: int = 20, width: int = SEARCH_BEAM, block: int = QUERY_BLOCK) -> DataFrame:
    """Per query its ``k`` nearest found: (query_id, rank, vec_id, score), nearest first, ties to the smaller id.

    Nearness is the inner product in double precision on the vectors as given. Candidates with
    the query's id are its own and left out. Every query meets every shard of its length, in
    blocks of ``block`` queries; a query row whose id repeats with another vector is answered
    for itself.
    """
    asked = usable(queries).withColumn("key", F.xxhash64("embedding"))
    asked = stored(asked, "queries")
    blocks = max(1, -(-asked.count() // block))
    shards = stored(index.select("shard", F.size("embedding").alias("dims")).distinct(), "shards")
    none = lambda kind: F.lit(None).cast(kind)
    # Queries are written once per shard and the index once per block of queries.
    dealt = (
        asked.withColumn("block", F.pmod(F.xxhash64("vec_id", "key"), F.lit(blocks)))
        .join(shards, F.size("embedding") == F.col("dims"))
        .select("shard", "block", F.lit(1).alias("kind"), "embedding", none("array<long>").alias("ids"), none("array<long>").alias("edges"), "vec_id", "key", none("long").alias("node"))
    )
    spread = index.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))).select(
        "shard", "block", F.lit(0).alias("kind"), "embedding", "ids", "edges", none("long").alias("vec_id"), none("long").alias("key"), "node"
    )
    met = spread.unionByName(dealt)
    tasks = shards.count() * blocks
    ordered = met.repartitionById(max(tasks, 1), (F.col("shard") * blocks + F.col("block")).cast("int")).sortWithinPartitions("shard", "block", "kind", "node")
    found = ordered.mapInArrow(_answers(k, width), ANSWERS)
    turn = F.row_number().over(Window.partitionBy("query_id", "embedding_key").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", turn).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest_neighbours(vectors: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """The ``k`` nearest of every vector whose id ``every`` divides, among all others.

    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor
    does a null id; without any others there are no rows. Only ``vec_id`` and ``embedding`` are read.
    """
    return nearest(build_index(vectors, k), vectors.where(F.col("vec_id") % every == 0), k)
