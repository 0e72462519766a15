"""Nearest neighbours by largest inner product with robust-pruned graphs.

Vectors are dealt by hash to shards of a bounded size. A shard's vectors form a
directed graph: a greedy search from the medoid proposes neighbours for each vector,
and robust pruning keeps the nearest and drops those that a kept one is closer to, in a first
pass at all and in a second by the factor :data:`RELAX`, so edges point in diverse directions. Each query searches
every shard with a beam; the shards' best are merged by the exact product in double
precision. How wide the beam must be depends on the vectors: each shard doubles it until
:data:`PROBES` of its own vectors, searched and compared with all of the shard, find
:data:`RECALL` of their nearest. For the graph, a further coordinate makes all vectors equally long, which
turns the largest product into the smallest distance; queries search by the product
itself, whose differences one very long vector cannot drown.

Equal vectors are one node: only its smallest ids can be in a result, and a node
brings as many of them as a result has rows (and one, for the query's own). All rows
are indexed; nothing is sampled.

Defined results: vectors that are null, zero, empty, hold null or non-finite values,
or have another length than most (of equally frequent lengths, the smallest counts)
take no part, as queries neither. Ties go to the
smaller id. Repeated rows with one id are one row. With fewer candidates than asked
for, all that are found come.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import written

SHARD_VECTORS = 4096      # about so many per shard
DEGREE = 32
BUILD_BEAM, SEARCH_BEAM = 64, 128
EXPAND = 4                # nodes a search expands at once
RELAX = 1.2
PROBES, RECALL = 64, 0.95
BATCH = 256
QUERY_BLOCK = 1 << 15     # queries that one task searches a shard for
SEED = 6


class Graph:
    """Directed graph over the rows of ``vectors``; ``edges`` holds -1 behind a node's neighbours.

    With ``products`` the distance is the negative product instead of the squared gap.
    """

    def __init__(self, vectors: np.ndarray, edges: np.ndarray, start: int, products: bool = False):
        self.vectors, self.edges, self.start, self.products = vectors, edges, start, products

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The nodes of each query's beam, nearest first, and their distances; -1 and inf behind."""
        n, m = len(self.vectors), len(queries)
        beam = max(1, min(beam, n))
        seen = np.zeros((m, n + 1), bool)
        seen[:, [self.start, n]] = True
        nodes = np.full((m, beam), -1)
        near = np.full((m, beam), np.inf, np.float32)
        nodes[:, 0] = self.start
        near[:, 0] = self.distances(queries, np.full((m, 1), self.start))[:, 0]
        done = np.ones((m, beam), bool)
        done[:, 0] = False
        live = np.arange(m)
        while len(live):
            waiting = np.where(done[live], np.inf, near[live])
            pick = np.argsort(waiting, axis=1, kind="stable")[:, :EXPAND]
            open_ = np.take_along_axis(waiting, pick, 1) < np.inf
            done[live[:, None], pick] = True
            source = np.where(open_, nodes[live[:, None], pick], -1)
            found = np.where(source[:, :, None] >= 0, self.edges[source], -1).reshape(len(live), -1)
            found.sort(axis=1)
            found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
            found[seen[live[:, None], found]] = -1
            seen[live[:, None], found] = True
            far = self.distances(queries[live], found)
            all_nodes = np.concatenate([nodes[live], found], 1)
            all_near = np.concatenate([near[live], far], 1)
            all_done = np.concatenate([done[live], np.zeros(found.shape, bool) | (found < 0)], 1)
            best = np.argsort(all_near, axis=1, kind="stable")[:, :beam]
            nodes[live] = np.take_along_axis(all_nodes, best, 1)
            near[live] = np.take_along_axis(all_near, best, 1)
            done[live] = np.take_along_axis(all_done, best, 1)
            live = live[(~done[live]).any(1)]
        return nodes, near

    def distances(self, queries: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        out = np.full(nodes.shape, np.inf, np.float32)
        r, c = np.nonzero(nodes >= 0)
        if self.products:
            out[r, c] = -np.einsum("ij,ij->i", self.vectors[nodes[r, c]], queries[r])
        else:
            gap = self.vectors[nodes[r, c]] - queries[r]
            out[r, c] = np.einsum("ij,ij->i", gap, gap)
        return out


def _prune(vectors: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """Robust pruning of each row's candidates (-1 for none) for the nodes ``own``."""
    candidates = np.sort(np.where(candidates == own[:, None], -1, candidates), axis=1)
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
    to_own = Graph(vectors, None, 0).distances(vectors[own], candidates)
    order = np.argsort(to_own, axis=1, kind="stable")
    candidates, to_own = np.take_along_axis(candidates, order, 1), np.take_along_axis(to_own, order, 1)
    points = vectors[candidates] - vectors[own][:, None]      # near to each other, so little is lost in the products
    squares = np.einsum("ijk,ijk->ij", points, points)
    between = squares[:, :, None] + squares[:, None, :] - 2 * points @ points.transpose(0, 2, 1)
    alive = np.isfinite(to_own)
    out = np.full((len(own), degree), -1)
    rows = np.arange(len(own))
    for i in range(degree):
        best = alive.argmax(1)
        some = alive[rows, best]
        if not some.any():
            break
        out[some, i] = candidates[rows, best][some]
        alive[rows, best] = False
        alive &= ~(some[:, None] & (relax ** 2 * between[rows, best] <= to_own))
    return out


def build(vectors: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, seed: int = SEED) -> Graph:
    """A graph over all rows of ``vectors``."""
    n = len(vectors)
    random = np.random.default_rng(seed)
    start = int(((vectors - vectors.mean(0)) ** 2).sum(1).argmin())
    edges = np.full((n + 1, degree), -1)
    if n > 1:
        edges[:n, :min(degree, n - 1)] = (np.arange(n)[:, None] + random.integers(1, n, (n, min(degree, n - 1)))) % n
    graph = Graph(vectors, edges, start)
    for relax in (1.0, RELAX):
        for own in np.array_split(random.permutation(n), -(-n // BATCH)):
            nodes, _ = graph.search(vectors[own], beam)
            edges[own] = _prune(vectors, own, np.concatenate([nodes, edges[own]], 1), degree, relax)
            # back edges; a node with too many neighbours is pruned again
            target, source = edges[own].ravel(), np.repeat(own, degree)
            source, target = source[target >= 0], target[target >= 0]
            order = np.argsort(target, kind="stable")
            source, target = source[order], target[order]
            first = np.flatnonzero(np.r_[True, target[1:] != target[:-1]]) if len(target) else np.zeros(0, int)
            size = np.diff(np.r_[first, len(target)])
            more = np.full((len(first), int(size.max(initial=0))), -1)
            more[np.repeat(np.arange(len(first)), size), np.arange(len(target)) - np.repeat(first, size)] = source
            for part in np.array_split(np.arange(len(first)), max(1, len(first) // BATCH)):
                nodes = target[first[part]]
                edges[nodes] = _prune(vectors, nodes, np.concatenate([edges[nodes], more[part]], 1), degree, relax)
    return _all_reachable(graph, beam)


def _reached(graph: Graph) -> np.ndarray:
    """Which nodes a walk along the edges can come to from the start."""
    n = len(graph.vectors)
    seen = np.zeros(n + 1, bool)
    front = np.array([graph.start])
    while len(front):
        seen[front] = True
        front = np.unique(graph.edges[front])
        front = front[(front >= 0) & ~seen[front]]
    return seen[:n]


def _all_reachable(graph: Graph, beam: int) -> Graph:
    """Pruning may leave nodes without an edge to them: each gets one from the nearest node that a search for it
    finds, into further columns of the edges."""
    while True:
        lost = np.flatnonzero(~_reached(graph))
        if not len(lost):
            return graph
        own = np.concatenate([graph.search(graph.vectors[part], beam)[0][:, 0] for part in np.array_split(lost, -(-len(lost) // BATCH))])
        order = np.argsort(own, kind="stable")
        own, lost = own[order], lost[order]
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        size = np.diff(np.r_[first, len(own)])
        more = np.full((len(graph.edges), int(size.max())), -1)
        more[own, np.arange(len(own)) - np.repeat(first, size)] = lost
        graph.edges = np.c_[graph.edges, more]


def wide_enough(graph: Graph, k: int, beam: int) -> int:
    """The beam, doubled from ``beam``, with which probes find RECALL of their ``k`` nearest by the product."""
    n = len(graph.vectors)
    probes = np.linspace(0, n - 1, min(n, PROBES)).astype(int)
    product = graph.vectors[probes] @ graph.vectors.T
    true = np.argpartition(-product, min(k, n) - 1, axis=1)[:, :k]
    while beam < n:
        found, _ = graph.search(graph.vectors[probes], beam)
        if np.mean([np.isin(t, f).mean() for t, f in zip(true, found)]) >= RECALL:
            return beam
        beam *= 2
    return n


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()) if len(column) else np.zeros((0, 0), np.float32)


def usable(table: DataFrame, vector: str) -> DataFrame:
    """The rows whose vector can take part; see the module's text."""
    v = F.col(vector)
    good = table.where(v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                       & F.exists(v, lambda x: x != 0))
    usual = good.groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), "n").first()
    return good.where(F.size(v) == F.lit(usual["n"] if usual else 0))


def nearest(table: DataFrame, is_query, k: int, key: str = "vec_id", vector: str = "embedding",
            beam: int = SEARCH_BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest rows found."""
    rows = usable(table, vector).where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).dropDuplicates(["id"])
    by = Window.partitionBy("v").orderBy("id")
    nodes = (rows.withColumn("r", F.row_number().over(by)).where(F.col("r") <= k + 1)
             .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    nodes = written(nodes.withColumn("node", F.col("ids")[0]), "ann-nodes")
    size = F.aggregate("v", F.lit(0.0).cast("double"), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, longest = nodes.agg(F.count("*"), F.max(size)).first()
    shards = -(-n // SHARD_VECTORS) or 1
    shard = F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int").alias("shard")
    longest, kind = float(longest or 0.0), table.schema[vector].dataType.simpleString()

    def index(part: pd.DataFrame) -> pd.DataFrame:
        original = _stack(part["v"]).astype(np.float32)
        rest = np.sqrt(np.maximum(longest - (original.astype(np.float64) ** 2).sum(1), 0)).astype(np.float32)
        graph = build(np.c_[original, rest])
        place = np.arange(len(part))
        wide = wide_enough(Graph(original, graph.edges, graph.start, products=True), k, beam)
        return pd.DataFrame({"shard": part["shard"], "place": place, "node": part["node"], "v": part["v"],
                             "edges": list(graph.edges[:-1]), "start": graph.start, "beam": wide})

    graphs = written(nodes.select(shard, "node", "v").groupBy("shard").applyInPandas(
        index, f"shard int, place int, node long, v {kind}, edges array<int>, start int, beam int"), "ann-graphs")
    queries = rows.where(is_query(F.col("id")))
    blocks = -(-queries.count() // QUERY_BLOCK) or 1
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    every = F.sequence(F.lit(0), F.lit(shards - 1)) if shards > 1 else F.array(F.lit(0))
    asked = queries.select("id", "v", block.alias("block"), F.explode(every).alias("shard"))
    each = F.sequence(F.lit(0), F.lit(blocks - 1)) if blocks > 1 else F.array(F.lit(0))
    held = graphs.withColumn("block", F.explode(each))

    def search(nodes: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(nodes) and len(asked):
            nodes = nodes.sort_values("place")
            exact = _stack(nodes["v"]).astype(np.float64)
            original, wide = exact.astype(np.float32), int(nodes["beam"].iloc[0])
            edges = _stack(nodes["edges"]).astype(np.int64)
            edges = np.r_[edges, np.full((1, edges.shape[1]), -1)]
            graph = Graph(original, edges, int(nodes["start"].iloc[0]), products=True)
            names, ids = nodes["node"].to_numpy(), asked["id"].to_numpy()
            wanted = _stack(asked["v"]).astype(np.float64)
            for a in range(0, len(ids), BATCH):
                q = wanted[a:a + BATCH]
                found, _ = graph.search(q.astype(np.float32), wide)
                score = np.stack([exact[f] @ x for f, x in zip(found, q)])
                score[found < 0] = -np.inf
                best = np.lexsort((names[found], -score), axis=1)[:, :k + 1]
                r, c = np.nonzero(np.take_along_axis(found, best, 1) >= 0)
                pick = best[r, c]
                out.append(pd.DataFrame({"query_id": ids[a:a + BATCH][r], "node": names[found[r, pick]],
                                         "score": score[r, pick]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "node": [], "score": []})

    hits = held.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(
        search, "query_id long, node long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "node")
    hits = hits.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)
    return (hits.join(nodes.select("node", "ids"), "node")
            .select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def op6_robust_graph(spark, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(table, lambda key: key % 20 == 0, 20)
