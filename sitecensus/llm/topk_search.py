"""Exact top-k search by inner product with two cover trees.

Queries and data are both indexed by cover trees: a node has a centre, which is one of its points, and a covering
radius. The centres of a node's children are a net of its points: every point is within half the node's radius of its
own centre, and the centres are farther than that from each other. Points that ``MOST_CHILDREN`` centres cannot cover
at half the radius have no structure that a bound could use at that scale, and stay together in one leaf. A pair of a
query node (centre q, radius r) and a data node (centre p, radius s) can reach at most q.p + |q| s + |p| r + r s. When
that is less than the worst kth score of the node's queries, no pair below can matter and the node pair is pruned;
otherwise the node with the larger radius is split, best children first. Leaves meet in matrix products of integers,
so scores are exact.

Data stays where it is read: each task indexes its rows in trees of bounded size and searches them with the
broadcast query tree. Queries come in blocks of at most ``query_block`` rows, one pass over the data each; each block's
result is written before the next one begins. The kth scores among a block's first rows against a bounded sample start
the pruning (any subset's kth score is a lower bound). A task returns k rows a query at most, and a window keeps the
best k of those.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

LEAF = 64  # queries
DATA_LEAF = 512
MOST_CHILDREN = 64
TILE = 1 << 20  # scores that are held at once
EXACT = 2.0**52
SLACK = 1e-9


class CoverTree:
    """points: n x d integers as floats. Nodes are arrays: centre (number of a point), radius, children or rows."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.points = points
        self.norms = np.sqrt((points * points).sum(axis=1))
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.children: list[list[int]] = []
        self.rows: list[np.ndarray] = []
        if not len(points):
            return
        every = np.arange(len(points))
        far = self._distances(every, 0)
        self._add(0, every, far)
        waiting = [(0, every, far)]
        while waiting:
            node, rows, far = waiting.pop()
            if len(rows) <= leaf or far.max() == 0 or not (net := self._net(rows, self.centre[node], far)):
                continue
            self.rows[node] = rows[:0]
            for part in net:
                self.children[node].append(self._add(*part))
                waiting.append((self.children[node][-1], part[1], part[2]))

    def _distances(self, rows: np.ndarray, centre: int) -> np.ndarray:
        d = self.points[rows] - self.points[centre]
        return np.sqrt((d * d).sum(axis=1))

    def _add(self, centre: int, rows: np.ndarray, far: np.ndarray) -> int:
        self.centre.append(centre)
        self.radius.append(float(far.max()))
        self.children.append([])
        self.rows.append(rows)
        return len(self.centre) - 1

    def _net(self, rows: np.ndarray, centre: int, far: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(centre, rows, distances) of each child; none if half the radius takes too many. Each next centre is the point
        that is farthest from those before."""
        centres, nearest, owner, half = [centre], far.copy(), np.zeros(len(rows), int), far.max() / 2
        while nearest.max() > half:
            if len(centres) == MOST_CHILDREN:
                return []
            centres.append(int(rows[nearest.argmax()]))
            d = self._distances(rows, centres[-1])
            closer = d < nearest
            nearest[closer], owner[closer] = d[closer], len(centres) - 1
        return [(c, rows[owner == i], nearest[owner == i]) for i, c in enumerate(centres)]


class Search:
    """The best k of the data seen so far, for every query of a query tree."""

    def __init__(self, queries: CoverTree, ids: np.ndarray, k: int, floors: np.ndarray):
        self.tree, self.ids, self.k = queries, ids, k
        self.floors = floors.copy()  # a score below a query's floor cannot be among its best k
        self.best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0), np.zeros(0, np.int64)) for _ in ids]
        self.below: list[np.ndarray] = [np.zeros(0, int)] * len(queries.centre)
        for node in range(len(queries.centre) - 1, -1, -1):  # children come after their node
            own = [queries.rows[node], *(self.below[c] for c in queries.children[node])]
            self.below[node] = np.concatenate(own).astype(int)
        self.pairs = 0

    def run(self, data: CoverTree, ids: np.ndarray) -> None:
        if not len(data.centre) or not len(self.tree.centre):
            return
        stack = [(0, 0, np.inf)]
        while stack:
            q, p, bound = stack.pop()
            if bound < self.floors[self.below[q]].min():
                continue
            split_query = bool(self.tree.children[q]) and (not data.children[p] or self.tree.radius[q] > data.radius[p])
            if split_query:
                pairs = [(c, p) for c in self.tree.children[q]]
            elif data.children[p]:
                pairs = [(q, c) for c in data.children[p]]
            else:
                self.leaves(q, p, data, ids)
                continue
            bounded = [(a, b, self.bound(a, b, data)) for a, b in pairs]
            stack += sorted(bounded, key=lambda x: x[2])  # the best is taken first

    def bound(self, q: int, p: int, data: CoverTree) -> float:
        a, b, r, s = self.tree.centre[q], data.centre[p], self.tree.radius[q], data.radius[p]
        top = self.tree.points[a] @ data.points[b] + self.tree.norms[a] * s + data.norms[b] * r + r * s
        return top + SLACK * (abs(top) + self.tree.norms[a] * data.norms[b] + 1)

    def leaves(self, q: int, p: int, data: CoverTree, ids: np.ndarray) -> None:
        queries, rows = self.tree.rows[q], data.rows[p]
        self.pairs += len(queries) * len(rows)
        step = max(1, TILE // len(rows))
        for first in range(0, len(queries), step):
            self.tile(queries[first : first + step], rows, data, ids)

    def tile(self, queries: np.ndarray, rows: np.ndarray, data: CoverTree, ids: np.ndarray) -> None:
        scores = self.tree.points[queries] @ data.points[rows].T
        if len(rows) > 4 * self.k and len(np.unique(ids[rows])) == len(rows):
            # k rows but the query's own score no less than the (k + 1)th of these
            kth = np.partition(scores, len(rows) - self.k - 1, axis=1)[:, len(rows) - self.k - 1]
            self.floors[queries] = np.maximum(self.floors[queries], kth)
        wanted = scores >= self.floors[queries, None]
        for i in np.flatnonzero(wanted.any(axis=1)):
            query = queries[i]
            hit = wanted[i] & (ids[rows] != self.ids[query])
            score = np.concatenate([self.best[query][0], scores[i, hit]])
            found = np.concatenate([self.best[query][1], ids[rows[hit]]])
            order = np.lexsort((found, -score))[: self.k]
            self.best[query] = score[order], found[order]
            if len(order) == self.k:
                self.floors[query] = max(self.floors[query], score[order[-1]])


def scaled(vector: Column) -> Column:
    """floor(1024 x) of every component, as doubles; null if the vector is null or has a component that is not finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scale = lambda x: x.cast("double") * 1024
    whole = lambda y: F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).otherwise(y)  # noqa: E731  larger doubles are whole
    return F.when(fine, F.transform(vector, lambda x: whole(scale(x))))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows; missing components at the end are zeros, as in a shorter vector of an inner product."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False).astype(float)
    sizes = np.diff(offsets)
    if len(sizes) and (sizes == width).all():
        return flat[offsets[0] : offsets[-1]].reshape(-1, width)
    out = np.zeros((len(sizes), width))
    for i, n in enumerate(sizes):
        out[i, : min(n, width)] = flat[offsets[i] : offsets[i] + min(n, width)]
    return out


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query_block: int = 20_000,
    tree_rows: int = 16_384,
    seed_rows: int = 2_000,
) -> DataFrame:
    """One row for each query and rank: query_id, rank (from 1), vec_id, score.

    score: the inner product of floor(1024 x). Each row of vectors is a candidate of each query but of those of
    its own id; ties go to the smaller vec_id. A query with fewer than k candidates gets them all. Rows without
    an id, and vectors null or with null or non-finite components, take no part. A shorter vector counts as
    filled up with zeros; so an empty one scores 0. Ids that occur twice as query are one query each, with equal
    rows. Scores must be below 2**52, else an error is raised. Other columns are not read.
    """
    spark = vectors.sparkSession
    slim = vectors.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), scaled(F.col(vector_col)).alias("v"), is_query.alias("is_query")).where("v is not null")
    queries = slim.where("is_query").select("vec_id", "v")
    n_queries = queries.count()
    n_blocks = max(1, -(-n_queries // query_block))
    seeds = slim.select("vec_id", "v").limit(seed_rows).toArrow()  # bounded
    parts = []
    for block in range(n_blocks):
        own = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == block) if n_blocks > 1 else queries
        part = _search_block(slim.select("vec_id", "v"), own.toArrow(), seeds, k, tree_rows, block)  # query_block rows, about
        parts.append(written(part, "top") if n_blocks > 1 else part)
    found = reduce(DataFrame.unionByName, parts)
    # one row a place: vectors that share an id are different candidates
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _search_block(data: DataFrame, queries: pa.Table, seeds: pa.Table, k: int, tree_rows: int, block: int) -> DataFrame:
    queries, seeds = queries.combine_chunks(), seeds.combine_chunks()
    column = lambda t, c: t.column(c).chunk(0) if t.num_rows else pa.array([], t.schema.field(c).type)
    ids = column(queries, "vec_id").to_numpy(zero_copy_only=False)
    vectors = column(queries, "v")
    width = max(1, int(np.diff(vectors.offsets.to_numpy()).max(initial=0))) if len(vectors) else 1
    points = _matrix(vectors, width) if len(vectors) else np.zeros((0, width))
    # the kth score of any candidates bounds the kth of all from below
    floors = np.full(len(ids), -np.inf)
    if len(ids) and seeds.num_rows:
        scores = points @ _matrix(column(seeds, "v"), width).T
        scores[ids[:, None] == column(seeds, "vec_id").to_numpy(zero_copy_only=False)[None, :]] = -np.inf
        if scores.shape[1] >= k:
            floors = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
    shared = data.sparkSession.sparkContext.broadcast((CoverTree(points, LEAF), ids, floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, query_ids, low = shared.value
        largest = np.abs(tree.points).sum(axis=1).max(initial=0)
        search = Search(tree, query_ids, k, low)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def index() -> None:
            if held:
                points = np.vstack([p for p, _ in held])
                if largest * np.abs(points).max(initial=0) >= EXACT:
                    raise ValueError("scores of 2**52 or more are not exact")
                search.run(CoverTree(points, DATA_LEAF), np.concatenate([i for _, i in held]))
                held.clear()

        for batch in batches:
            if len(query_ids) and batch.num_rows:
                held.append((_matrix(batch.column(1), tree.points.shape[1]), batch.column(0).to_numpy()))
                if sum(len(i) for _, i in held) >= tree_rows:
                    index()
        index()
        at = np.repeat(np.arange(len(query_ids)), [len(s) for s, _ in search.best])
        if len(at):
            score, other = (np.concatenate([b[j] for b in search.best]) for j in (0, 1))
            columns = [at + (block << 32), query_ids[at], other, score.astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_row", "query_id", "vec_id", "score"])

    return data.mapInArrow(run, "query_row long, query_id long, vec_id long, score long")
