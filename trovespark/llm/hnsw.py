"""Approximate nearest neighbours by one hierarchical navigable small-world graph per shard.

Vectors are dealt to shards of bounded size by a hash of their id. In a shard equal vectors are one node; nodes get
random levels and are inserted in random order, in batches: a batch walks down the levels of the graph so far, greedily
above a node's level and with a wide beam from there on, and of what a beam finds (and of the batch's own nodes) a
spread-out few become the node's neighbours and link back. A graph is stored as flat arrays of neighbour numbers. Beams
walk for many queries in step, by array operations. Searches walk down the levels of every shard, and the shards' results
are merged. Every row is indexed.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from trovespark.frames import materialise, pick, release

#: Rows in a shard, neighbours on the upper levels and on the lowest, candidates for insertion, breadth of a search.
SHARD_ROWS, LINKS, GROUND_LINKS, BUILD_BREADTH, SEARCH_BREADTH = 8192, 16, 32, 64, 160
#: Queries that meet a shard's graph in one task.
QUERY_BLOCK = 20_000
INDEX = "dim int, shard int, ids binary, starts binary, vectors binary, levels binary, nodes binary, neighbours binary"


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows of a to rows of b, by one matrix product about a common centre."""
    centre = b.mean(0)
    a, b = a - centre, b - centre
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T), 0)


def spread(distance: np.ndarray, between: np.ndarray, most: int) -> list[int]:
    """Of candidates in order of distance those nearer to the node than to any one chosen before; then the nearest of
    the rest, up to `most`."""
    chosen, nearest = [], np.full(len(distance), np.inf)
    for i in range(len(distance)):
        if distance[i] < nearest[i]:
            chosen.append(i)
            if len(chosen) == most:
                return chosen
            np.minimum(nearest, between[i], out=nearest)
    rest = [i for i in range(len(distance)) if i not in set(chosen)]
    return chosen + rest[: most - len(chosen)]


#: Nodes inserted in one batch, and queries that walk in step.
BATCH = 256


def beam(vectors: np.ndarray, table: np.ndarray, queries: np.ndarray, entries: np.ndarray, breadth: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query the nodes that a best-first walk from its entry finds, nearest first, and their squared distances:
    `breadth` columns, -1 and infinity where there are fewer. `table` has a row of neighbours (-1: none) for each node."""
    q = len(queries)
    rows, seen = np.arange(q), np.zeros((q, len(vectors) + 1), bool)
    seen[:, -1] = True  # where a neighbour number of -1 points
    ids, far, done = np.full((q, breadth), -1, np.int64), np.full((q, breadth), np.inf), np.ones((q, breadth), bool)
    gap = vectors[entries] - queries
    ids[:, 0], far[:, 0], done[:, 0], seen[rows, entries] = entries, (gap * gap).sum(1), False, True
    while len(rows):
        waiting = np.where(done[rows], np.inf, far[rows])
        at = waiting.argmin(1)
        live = waiting[np.arange(len(rows)), at] < np.inf
        rows, at = rows[live], at[live]
        if not len(rows):
            break
        done[rows, at] = True
        around = table[ids[rows, at]]
        of, place = np.nonzero(~seen[rows[:, None], around])
        node = around[of, place]
        seen[rows[of], node] = True
        gap = vectors[node] - queries[rows[of]]
        new = np.full(around.shape, np.inf)
        new[of, place] = np.einsum("ij,ij->i", gap, gap)
        both = np.concatenate([far[rows], new], 1)
        keep = np.argpartition(both, breadth - 1, 1)[:, :breadth]
        far[rows] = np.take_along_axis(both, keep, 1)
        ids[rows] = np.take_along_axis(np.concatenate([ids[rows], around], 1), keep, 1)
        done[rows] = np.take_along_axis(np.concatenate([done[rows], ~np.isfinite(new)], 1), keep, 1)
    ids[~np.isfinite(far)] = -1
    order = np.lexsort((ids, far), axis=1)
    return np.take_along_axis(ids, order, 1), np.take_along_axis(far, order, 1)


class Graph:
    """A shard's graph: for each level a row of neighbour numbers (-1: none) for each of its nodes; all nodes are on level 0."""

    def __init__(self, vectors: np.ndarray, levels: np.ndarray, nodes: list[np.ndarray], neighbours: list[np.ndarray]):
        self.vectors, self.levels, self.nodes, self.neighbours = vectors, levels, nodes, neighbours
        self.tables = [neighbours[0]] if neighbours else []
        for level, own in zip(nodes[1:], neighbours[1:]):
            table = np.full((len(vectors), own.shape[1]), -1, np.int32)
            table[level] = own
            self.tables.append(table)
        self.entry = int(np.argmax(levels)) if len(levels) else -1

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int, links: int = LINKS, ground: int = GROUND_LINKS, breadth: int = BUILD_BREADTH) -> Graph:
        n = len(vectors)
        rng = np.random.default_rng(seed)
        levels = np.minimum((-np.log(1 - rng.random(n)) / math.log(links)).astype(np.uint8), 15)
        order = rng.permutation(n)
        most = [ground, *[links] * int(levels.max(initial=0))]
        rooms = [np.full((n, 2 * m), -1, np.int32) for m in most]
        used = [np.zeros(n, np.int32) for _ in most]

        def pruned(level: int, i: int) -> None:
            found = np.unique(rooms[level][i, : used[level][i]])
            away = squared(vectors[i : i + 1], vectors[found])[0]
            near = np.argsort(away, kind="stable")
            found, away = found[near], away[near]
            kept = found[spread(away, squared(vectors[found], vectors[found]), most[level])]
            rooms[level][i] = -1
            rooms[level][i, : len(kept)], used[level][i] = kept, len(kept)

        def linked(level: int, i: int, found: np.ndarray, away: np.ndarray) -> None:
            chosen = found[spread(away, squared(vectors[found], vectors[found]), most[level] // 2)]
            for a, others in ((i, chosen), *((j, (i,)) for j in chosen.tolist())):
                for other in others:
                    if used[level][a] == 2 * most[level]:
                        pruned(level, a)
                    rooms[level][a, used[level][a]] = other
                    used[level][a] += 1

        entry, at = int(order[0]) if n else -1, 1
        while at < n:
            batch = order[at : at + max(1, min(BATCH, at // 2))]
            starts, within = np.full(len(batch), entry), squared(vectors[batch], vectors[batch])
            for level in range(len(most) - 1, -1, -1):
                if level > levels[entry]:
                    nearest = None  # no node inserted so far is on this level
                else:
                    nearest = np.full((len(batch), breadth), -1, np.int64), np.full((len(batch), breadth), np.inf)
                    for wide, own in ((1, np.flatnonzero(levels[batch] < level)), (breadth, np.flatnonzero(levels[batch] >= level))):
                        if len(own):
                            ids, far = beam(vectors, rooms[level], vectors[batch[own]], starts[own], wide)
                            nearest[0][own, :wide], nearest[1][own, :wide] = ids, far
                            starts[own] = ids[:, 0]
                for j in np.flatnonzero(levels[batch] >= level):
                    mates = np.flatnonzero(levels[batch[:j]] >= level)
                    found, away = batch[mates], within[j, mates]
                    if nearest is not None:
                        real = nearest[0][j] >= 0
                        found, away = np.concatenate([nearest[0][j][real], found]), np.concatenate([nearest[1][j][real], away])
                    near = np.lexsort((found, away))[:breadth]
                    if len(near):
                        linked(level, int(batch[j]), found[near], away[near])
            entry = max([entry, *batch.tolist()], key=lambda i: levels[i])
            at += len(batch)
        nodes, neighbours = [], []
        for level, m in enumerate(most):
            for i in np.flatnonzero(used[level] > m):
                pruned(level, int(i))
            own = np.flatnonzero(levels >= level).astype(np.int32)
            nodes.append(own)
            neighbours.append(np.ascontiguousarray(rooms[level][own, :m]))
        return cls(vectors, levels, nodes, neighbours)

    def search(self, query: np.ndarray, breadth: int) -> np.ndarray:
        """Numbers of the nodes found nearest to the query, nearest first."""
        found = self.search_all(query[None], breadth)[0]
        return found[found >= 0]

    def search_all(self, queries: np.ndarray, breadth: int) -> np.ndarray:
        """For each query the nodes found nearest, nearest first; -1 fills up."""
        if self.entry < 0:
            return np.zeros((len(queries), 0), np.int64)
        at = np.full(len(queries), self.entry)
        for table in self.tables[:0:-1]:
            at = beam(self.vectors, table, queries, at, 1)[0][:, 0]
        return beam(self.vectors, self.tables[0], queries, at, min(breadth, len(self.vectors)))[0]


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, empty or zero, and all its components finite."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _build(group: pd.DataFrame) -> pd.DataFrame:
    all_vectors = np.array(group.vector.tolist(), np.float64) + 0.0
    vectors, place = np.unique(all_vectors, axis=0, return_inverse=True)
    own = np.unique(np.stack([place.reshape(-1), group.vec_id.to_numpy(np.int64)], 1), axis=0)  # a node's distinct ids
    ids = np.ascontiguousarray(own[:, 1])
    starts = np.searchsorted(own[:, 0], np.arange(len(vectors) + 1)).astype(np.int32)
    graph = Graph.build(vectors, int(group.shard.iloc[0]))
    sizes = np.array([len(x) for x in graph.nodes[1:]], np.int32)
    nodes = np.concatenate([np.array([len(sizes)], np.int32), sizes, *graph.nodes[1:]]).astype(np.int32)
    row = (int(group.dim.iloc[0]), int(group.shard.iloc[0]), ids.tobytes(), starts.tobytes(), vectors.tobytes(), graph.levels.tobytes(), nodes.tobytes(), b"".join(t[own].tobytes() for t, own in zip(graph.tables, graph.nodes)))
    return pd.DataFrame([row], columns=[c.split()[0] for c in INDEX.split(", ")])


def read_graph(row) -> tuple[Graph, np.ndarray, np.ndarray]:
    """The graph of an index row, its ids by node, and where each node's ids begin."""
    levels, nodes = np.frombuffer(row.levels, np.uint8), np.frombuffer(row.nodes, np.int32)
    n, sizes = len(levels), nodes[1 : 1 + nodes[0]]
    cut = np.cumsum([1 + nodes[0], *sizes])
    flat = np.frombuffer(row.neighbours, np.int32)
    tables, at = [flat[: n * GROUND_LINKS].reshape(n, GROUND_LINKS)], n * GROUND_LINKS
    for size in sizes:
        tables.append(flat[at : at + size * LINKS].reshape(size, LINKS))
        at += size * LINKS
    graph = Graph(np.frombuffer(row.vectors, np.float64).reshape(n, row.dim), levels, [np.arange(n, dtype=np.int32), *(nodes[a:b] for a, b in zip(cut, cut[1:]))], tables)
    return graph, np.frombuffer(row.ids, np.int64), np.frombuffer(row.starts, np.int32)


def build(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The index, a row for each shard, of every usable vector of `vectors` (vec_id, vector); a table to release.

    Vectors of different dimension are in different shards. A null id takes no part.
    """
    rows = vectors.where(usable(F.col("vector")) & F.col("vec_id").isNotNull()).withColumn("dim", F.size("vector"))
    sizes = rows.groupBy("dim").count().collect()
    shards = F.lit(1)
    for r in sizes:
        shards = F.when(F.col("dim") == r.dim, F.lit(math.ceil(r["count"] / shard_rows))).otherwise(shards)
    placed = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), shards).cast("int"))
    return materialise(placed.select("dim", "shard", "vec_id", "vector").groupBy("dim", "shard").applyInPandas(_build, INDEX), "hnsw")


def _answer(index: pd.DataFrame, queries: pd.DataFrame, k: int, breadth: int) -> pd.DataFrame:
    out: list[tuple[int, int, float]] = []
    for row in index.itertuples():
        graph, ids, starts = read_graph(row)
        asked, points = queries.query_id.to_numpy(np.int64), np.array(queries.vector.tolist(), np.float64).reshape(len(queries), -1)
        for at in range(0, len(queries), BATCH):
            left, wide = np.arange(at, min(at + BATCH, len(queries))), max(breadth, 4 * k)
            while len(left):  # wider where repeated ids leave fewer than k others
                again = []
                for i, near in zip(left.tolist(), graph.search_all(points[left], wide)):
                    found: dict[int, float] = {}
                    for node in near[near >= 0].tolist():
                        gap = graph.vectors[node] - points[i]
                        away = float(np.sqrt((gap * gap).sum()))
                        for other in ids[starts[node] : min(starts[node + 1], starts[node] + k + 1)].tolist():  # distinct: k others
                            if other != asked[i]:
                                found[other] = min(away, found.get(other, away))
                    if len(found) < k and wide < len(graph.vectors):
                        again.append(i)
                    else:
                        out += [(int(asked[i]), other, away) for away, other in sorted((away, other) for other, away in found.items())[:k]]
                left, wide = np.array(again, np.int64), 2 * wide
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})


def search(index: DataFrame, queries: DataFrame, k: int = 10, breadth: int = SEARCH_BREADTH) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest found, smallest Euclidean distance first, ties to smaller ids.

    Queries (query_id, vector) meet every shard of their dimension in blocks of bounded size.
    """
    rows = queries.where(usable(F.col("vector")) & F.col("query_id").isNotNull()).withColumn("dim", F.size("vector"))
    blocks = max(1, math.ceil(rows.count() / QUERY_BLOCK))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    shards = F.broadcast(index.select(F.col("dim").alias("_dim"), F.col("shard").alias("_shard")))  # two numbers a shard
    asked = rows.join(shards, rows.dim == F.col("_dim")).select("dim", F.col("_shard").alias("shard"), "block", "query_id", "vector")
    there = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ("dim", "shard", "block")
    found = there.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(lambda i, q: _answer(i, q, k, breadth), "query_id bigint, vec_id bigint, score double")
    nearest = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return nearest.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, every: int = 100, k: int = 10, shard_rows: int = SHARD_ROWS, breadth: int = SEARCH_BREADTH) -> DataFrame:
    """The k nearest rows of each row whose vec_id `every` divides, itself left out.

    `vectors` has vec_id and embedding. Vectors that are null, empty or zero, or hold null or non-finite components, and
    rows with a null id take no part; only vectors of one dimension are compared. Rows that repeat an id are one item
    with several vectors, as near as the nearest of them. An empty table gives none; other columns are left out whatever
    their names.
    """
    rows = pick(vectors, vec_id="bigint", embedding="array<double>").select("vec_id", F.col("embedding").alias("vector"))
    index = build(rows, shard_rows)
    asked = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vector")
    out = materialise(search(index, asked, k, breadth), "nearest")
    release(index)
    return out
