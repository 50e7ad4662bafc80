"""Nearest neighbours by inner product over vantage-point trees, one tree a shard.

A shard is a run of rows of one input split. Its vectors get one more component,
the root of M^2 - |x|^2 with M the shard's largest length, and a query gets 0
there: the nearest by Euclidean distance are then those of the largest inner
product, whatever the lengths. Equal vectors of a shard are one point with all
their ids. A node keeps a vantage point and, for either child, the least and the
greatest distance from it; leaves hold ``LEAF`` points.

A block of queries goes through a shard's tree together. Each query first looks
into the leaf that the vantage points lead it to, then the tree is walked once
from its root: a child is left out if ``factor`` times the triangle inequality's
lower bound is over the distance of the query's worst neighbour so far. Factor 1
gives the exact neighbours, a greater one prunes more (vectors spread evenly over
many dimensions are nearly as far from each other as from any vantage point, and
little can be pruned at all). Neighbours found in a
task's earlier shards prune its later ones.

Scale: the index is landed once, a row a shard. Queries are landed in blocks of at
most ``BLOCK_BYTES``; each block is broadcast in turn and meets all shards in one
pass, and a task returns a query's best ``k`` only. No vector is shuffled.

Products that may count are summed again in a fixed order, so equal vectors have
equal scores in any shard, and ties go to the smaller id. Defined cases: vectors
that are null, zero or hold a null or non-finite component take no part, as do
rows without id; vectors meet only those of their own length; every query row is
answered, but never by rows of its own id; repeated rows are candidates each;
without candidates a query has no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeloom.session import scratch_folder

NEIGHBOURS, FACTOR = 20, 1.05
SHARD_ROWS, LEAF = 4096, 64
BLOCK_BYTES = 32 << 20

_SHARD = "size int, points binary, ids binary, ends binary, vantage binary, bounds binary"


def _vectors(batch: pa.RecordBatch, column: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) of the usable vectors for each length."""
    lists = batch.column(column)
    flat = lists.flatten().cast(pa.float64())
    values = flat.to_numpy(zero_copy_only=False)  # null: NaN
    n = np.diff(lists.offsets.to_numpy())
    n = np.where(np.asarray(lists.is_valid()), n, 0)
    ends = np.cumsum(n)
    out = []
    for size in np.unique(n[n > 0]).tolist():
        rows = np.flatnonzero(n == size)
        x = values[(ends[rows] - size)[:, None] + np.arange(size)]
        good = np.isfinite(x).all(axis=1) & x.any(axis=1)
        out.append((rows[good], x[good]))
    return out


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, each summed in one fixed order."""
    return np.ascontiguousarray(a * b).sum(axis=1)


class Tree:
    """A balanced tree over distinct vectors; nodes are numbered as in a heap, their points lie side by side."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, ends: np.ndarray, vantage: np.ndarray | None = None, bounds: np.ndarray | None = None):
        self.points, self.ids, self.ends = points, ids, ends
        length = (points * points).sum(axis=1)
        self.longest = float(length.max())
        self.extra = np.sqrt(np.maximum(self.longest - length, 0))
        self.vantage, self.bounds = vantage, bounds

    @classmethod
    def build(cls, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF) -> Tree:
        distinct, which = np.unique(points, axis=0, return_inverse=True)
        which = which.ravel()
        depth = max(0, math.ceil(math.log2(max(1, len(distinct) / leaf))))
        length = (distinct * distinct).sum(axis=1)
        space = np.concatenate([distinct, np.sqrt(np.maximum(length.max() - length, 0))[:, None]], axis=1)
        order = np.arange(len(distinct))
        vantage, bounds = np.zeros(2 ** depth - 1, np.int64), np.zeros((2 ** depth - 1, 4))
        for node, lo, hi in _inner(len(distinct), depth):
            own = order[lo:hi]
            sample = space[own[:: max(1, len(own) // 64)]]
            some = own[:: max(1, len(own) // 8)]
            spread = [np.linalg.norm(sample - space[v], axis=1).var() for v in some]
            v = int(some[int(np.argmax(spread))])
            far = np.linalg.norm(space[own] - space[v], axis=1)
            by = np.argsort(far, kind="stable")
            order[lo:hi], far = own[by], far[by]
            mid = (hi - lo) // 2
            vantage[node], bounds[node] = v, (far[0], far[mid - 1], far[mid], far[-1])
        place = np.empty(len(distinct), np.int64)
        place[order] = np.arange(len(distinct))
        row = np.lexsort((ids, place[which]))
        ends = np.concatenate(([0], np.cumsum(np.bincount(place[which], minlength=len(distinct)))))
        return cls(np.ascontiguousarray(distinct[order]), ids[row], ends, place[vantage], bounds)


def _inner(n: int, depth: int):
    """(node, first point, end) of the inner nodes, from the root down."""
    for level in range(depth):
        spans = [(0, n)]
        for _ in range(level):
            spans = [half for lo, hi in spans for half in ((lo, lo + (hi - lo) // 2), (lo + (hi - lo) // 2, hi))]
        yield from ((2 ** level - 1 + i, lo, hi) for i, (lo, hi) in enumerate(spans))


class Search:
    """The best ``k`` of a block of queries in the trees met so far."""

    def __init__(self, queries: np.ndarray, own: np.ndarray, k: int, factor: float):
        self.q, self.own, self.k, self.factor = queries, own, k, factor
        self.length = (queries * queries).sum(axis=1)
        self.score, self.id = np.full((len(queries), k), -np.inf), np.full((len(queries), k), np.iinfo(np.int64).max)
        self.products = 0

    def through(self, tree: Tree) -> None:
        n, self.tree = len(tree.points), tree
        depth = (len(tree.vantage) + 1).bit_length() - 1
        every = np.arange(len(self.q))
        home = np.zeros(len(self.q), np.int64)
        to_vantage = self._distance(self.q @ tree.points[tree.vantage].T, every[:, None]) if depth else np.empty((len(self.q), 0))
        for _ in range(depth):
            b, d = tree.bounds[home], to_vantage[every, home]
            home = 2 * home + 1 + (np.maximum(d - b[:, 1], b[:, 0] - d) > np.maximum(d - b[:, 3], b[:, 2] - d))
        first = 2 ** depth - 1
        for leaf in np.unique(home).tolist():
            self._leaf(np.flatnonzero(home == leaf), *_span(n, depth, leaf - first))
        stack = [(0, every)]
        while stack:
            node, active = stack.pop()
            if node >= first:
                active = active[home[active] != node]
                if active.size:
                    self._leaf(active, *_span(n, depth, node - first))
                continue
            b, d = tree.bounds[node], to_vantage[active, node]
            worst = self._distance(self.score[active, -1], active) + 1e-9
            for child, low, high in ((2 * node + 2, b[2], b[3]), (2 * node + 1, b[0], b[1])):
                good = self.factor * np.maximum(d - high, low - d) <= worst
                if good.any():
                    stack.append((child, active[good]))

    def _distance(self, product: np.ndarray, which: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.tree.longest + self.length[which] - 2 * product, 0))

    def _leaf(self, active: np.ndarray, lo: int, hi: int) -> None:
        tree = self.tree
        product = self.q[active] @ tree.points[lo:hi].T
        self.products += product.size
        slack = 1e-12 * np.sqrt(tree.longest * self.length[active]) + 1e-300
        row, point = np.nonzero(product >= (self.score[active, -1] - slack)[:, None])
        if not row.size:
            return
        query, point = active[row], point + lo
        score = exact_products(self.q[query], tree.points[point])
        # of equal vectors the k + 1 smallest ids are all that can count, one may be the query's own
        n = np.minimum(np.diff(tree.ends)[point], self.k + 1)
        at = np.repeat(tree.ends[point] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        query, score, ids = np.repeat(query, n), np.repeat(score, n), tree.ids[at]
        other = ids != self.own[query]
        met = np.unique(query)
        query = np.concatenate([query[other], np.repeat(met, self.k)])
        score, ids = np.concatenate([score[other], self.score[met].ravel()]), np.concatenate([ids[other], self.id[met].ravel()])
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        start = np.searchsorted(query, met)
        take = start[:, None] + np.arange(self.k)
        self.score[met], self.id[met] = score[take], ids[take]


def _span(n: int, depth: int, leaf: int) -> tuple[int, int]:
    lo, hi = 0, n
    for level in reversed(range(depth)):
        mid = lo + (hi - lo) // 2
        lo, hi = (mid, hi) if leaf >> level & 1 else (lo, mid)
    return lo, hi


def build_index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD_ROWS, leaf: int = LEAF) -> DataFrame:
    """A row a shard: its vectors' length, points, ids and tree as bytes."""
    src = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")).where("id is not null")

    def run(batches):
        held: dict[int, list] = {}

        def shard(size):
            x, ids = (np.concatenate(c) for c in zip(*held.pop(size), strict=True))
            t = Tree.build(x, ids, leaf)
            row = [t.points.tobytes(), t.ids.tobytes(), t.ends.tobytes(), t.vantage.tobytes(), t.bounds.tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([size], pa.int32()), *(pa.array([b], pa.binary()) for b in row)], names=["size", "points", "ids", "ends", "vantage", "bounds"])
        for batch in batches:
            ids = batch.column("id").to_numpy()
            for rows, x in _vectors(batch, "vector"):
                for at in range(0, len(rows), shard_rows):
                    part, size = rows[at:at + shard_rows], x.shape[1]
                    if sum(len(i) for _, i in held.get(size, ())) + len(part) > shard_rows and size in held:
                        yield shard(size)
                    held.setdefault(size, []).append((x[at:at + shard_rows], ids[part]))
        for size in sorted(held):
            yield shard(size)
    return src.mapInArrow(run, _SHARD)


def _block_pass(index: DataFrame, sent, k: int, factor: float) -> DataFrame:
    """Each task's best of a block of queries: (number, id, score)."""
    def run(batches):
        numbers, own, queries = sent.value
        by_size = {}
        for size in {len(q) for q in queries}:
            rows = np.array([i for i, q in enumerate(queries) if len(q) == size])
            by_size[size] = rows, Search(np.stack([queries[i] for i in rows]).astype(np.float64), own[rows], k, factor)
        for batch in batches:
            for i in range(batch.num_rows):
                size = batch.column("size")[i].as_py()
                if size in by_size:
                    points, ids, ends, vantage, bounds = (np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in
                                                          (("points", np.float64), ("ids", np.int64), ("ends", np.int64), ("vantage", np.int64), ("bounds", np.float64)))
                    by_size[size][1].through(Tree(points.reshape(-1, size), ids, ends, vantage, bounds.reshape(-1, 4)))
        for rows, found in by_size.values():
            at = np.isfinite(found.score)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(numbers[rows], at.sum(axis=1))), pa.array(found.id[at]), pa.array(found.score[at])], names=["number", "id", "score"])
    return index.mapInArrow(run, "number long, id long, score double")


def search(vectors: DataFrame, is_query: Column, k: int = NEIGHBOURS, factor: float = FACTOR, id_col: str = "vec_id", vector_col: str = "embedding",
           block_bytes: int = BLOCK_BYTES, **index_options) -> DataFrame:
    """The ``k`` nearest found of each query row: query_id, rank, vec_id, score."""
    if factor < 1:
        raise ValueError("a factor of 1 is exact; a smaller one only costs time")
    spark = vectors.sparkSession
    root = scratch_folder(spark, "vantage")
    build_index(vectors, id_col, vector_col, **index_options).write.parquet(f"{root}/index")
    index = spark.read.parquet(f"{root}/index")
    vector = F.col(vector_col).cast("array<double>")
    fit = F.col(id_col).isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0)
    asked = vectors.where(is_query & fit).select(F.monotonically_increasing_id().alias("number"), F.col(id_col).cast("long").alias("query_id"), vector.alias("vector"))
    asked.write.parquet(f"{root}/asked")
    asked = spark.read.parquet(f"{root}/asked")
    total = asked.agg(F.coalesce(F.sum(8 * F.size("vector") + 20 * k + 64), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(1.25 * total / block_bytes))
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("number"), F.lit(blocks)) == b).toArrow()
        own = rows.column("vector").combine_chunks()
        queries = np.split(own.flatten().to_numpy(zero_copy_only=False), np.diff(own.offsets.to_numpy()).cumsum()[:-1]) if rows.num_rows else []
        sent = spark.sparkContext.broadcast((rows.column("number").to_numpy(), rows.column("query_id").to_numpy(), queries))
        _block_pass(index, sent, k, factor).write.parquet(f"{root}/found/block={b}")
        sent.unpersist()
    order = Window.partitionBy("number").orderBy(F.desc("score"), "id")
    best = spark.read.parquet(f"{root}/found").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(asked.select("number", "query_id"), "number").select("query_id", "rank", F.col("id").alias("vec_id"), "score")
