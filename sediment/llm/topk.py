"""Exact top-k inner-product search with KD-trees per shard.

Vectors are dealt into shards by their place in the table.  Each shard builds a KD-tree once,
which is stored with the vectors in its order: nodes are split at the median of their widest
dimension, and every node has the tight box of its vectors.
The largest inner product a query can have inside a box takes, per dimension, the better end of
the box; with the query's positive and negative parts that bound is two dot products.

Queries come in blocks.  A traversal is best-first: per query the open node with the highest
bound is next, and a node whose bound is below the query's k-th score so far is never opened.
Every block is searched in one shard first, then in rounds of four times as many shards as so far;
the k-th scores found so far go with the block into the next round, where they prune from the
start.  Per query, a shard returns only scores that can still be among the best k, and after
every round the best k are taken by window, so what is kept does not grow with the shards.

The queries are a stated set (ids divisible by ``every``) and meet the rows in blocks: one pair
of a query block and a shard is one unit of work, paired by an equi-join on the shard.

Defined cases: vectors that are null, hold null or non-finite components, or have no id take no
part; a repeated id is found as often as it stands (but never for a query of the same id); vectors
of another length than most are compared with those of their own length only; ties go to the
smaller id; with fewer candidates than k all are returned; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sediment.llm.common import discard, small_batches, with_places, written

SHARD_ROWS = 8192
BLOCK_ROWS = 1024
LEAF_ROWS = 64
ROUND_GROWTH = 4
PACKED = "dim int, shard int, n long, ids binary, vectors binary"
STORED = PACKED + ", tree binary"
FOUND = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, dim, v array<double>) of the vectors that take part."""
    v = F.col("embedding").cast("array<double>")
    kept = vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.size(v).alias("dim"), v.alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return kept.where(~bad & (F.col("dim") > 0)).withColumn(
        "v", F.transform("v", lambda x: F.floor(x * scale).cast("double")))


def _pack(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
    """One (dim, shard) of bounded size as one row."""
    dim, shard = (k.as_py() for k in key)
    order = np.argsort(t.column("vec_id").to_numpy(), kind="stable")
    ids = t.column("vec_id").to_numpy()[order]
    flat = t.column("v").combine_chunks().flatten().to_numpy()
    rows = flat.reshape(-1, dim)[order]
    return pa.table({"dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int32()),
                     "n": pa.array([len(ids)], pa.int64()), "ids": [ids.astype("<i8").tobytes()],
                     "vectors": [rows.astype("<f4" if _small(rows) else "<f8").tobytes()]})


def _small(rows: np.ndarray) -> bool:
    return not rows.size or float(np.abs(rows).max()) < 2 ** 24


def _unpack(ids: bytes, vectors: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    own = np.frombuffer(ids, "<i8")
    kind = "<f4" if len(vectors) == 4 * dim * len(own) else "<f8"
    return own, np.frombuffer(vectors, kind).astype(np.float64).reshape(-1, dim)


def _store(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
    """A packed shard in the order of its tree, with the tree."""
    own = _pack(key, t)
    ids, points = _unpack(own.column("ids")[0].as_py(), own.column("vectors")[0].as_py(), key[0].as_py())
    tree = KdTree.build(points)
    placed = points[tree.order]
    kind = "<f4" if _small(placed) else "<f8"
    return pa.table({**{c: own.column(c) for c in ("dim", "shard", "n")},
                     "ids": [ids[tree.order].tobytes()], "vectors": [placed.astype(kind).tobytes()],
                     "tree": [tree.dump()]})


class KdTree:
    """Median splits; ``low``/``high`` are the tight boxes; leaves are runs of the tree's order;
    ``child`` holds the two children of a node, or -1."""

    def __init__(self, low: np.ndarray, high: np.ndarray, child: np.ndarray, span: np.ndarray,
                 order: np.ndarray | None = None):
        self.low, self.high, self.child, self.span, self.order = low, high, child, span, order

    @classmethod
    def build(cls, points: np.ndarray, leaf_rows: int = LEAF_ROWS) -> KdTree:
        order = np.arange(len(points))
        low, high, child, span = [], [], [], []

        def split(a: int, b: int) -> int:
            node, own = len(span), points[order[a:b]]
            low.append(own.min(axis=0))
            high.append(own.max(axis=0))
            span.append((a, b))
            child.append((-1, -1))
            wide = int(np.argmax(high[node] - low[node]))
            if b - a > leaf_rows and high[node][wide] > low[node][wide]:
                mid = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(own[:, wide], mid, kind="introselect")]
                child[node] = (split(a, a + mid), split(a + mid, b))
            return node

        if len(points):
            split(0, len(points))
        d = points.shape[1]
        return cls(np.array(low).reshape(-1, d), np.array(high).reshape(-1, d),
                   np.array(child, np.int32).reshape(-1, 2), np.array(span, np.int32).reshape(-1, 2), order)

    def dump(self) -> bytes:
        return b"".join((np.int64(len(self.span)).tobytes(), self.child.astype("<i4").tobytes(),
                         self.span.astype("<i4").tobytes(), self.low.astype("<f8").tobytes(),
                         self.high.astype("<f8").tobytes()))

    @classmethod
    def load(cls, data: bytes, dim: int) -> KdTree:
        n = int(np.frombuffer(data, "<i8", 1)[0])
        links = np.frombuffer(data, "<i4", 4 * n, 8).reshape(2, n, 2)
        boxes = np.frombuffer(data, "<f8", 2 * n * dim, 8 + 16 * n).reshape(2, n, dim)
        return cls(boxes[0], boxes[1], links[0], links[1])

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The highest inner product each query can have in each node's box."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T


def search(tree: KdTree, ids: np.ndarray, points: np.ndarray, query_ids: np.ndarray, queries: np.ndarray,
           k: int, floor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each query: (query id, ids, scores) of the points (in the tree's order) that can be among
    its best k, given that ``floor`` (its k-th score elsewhere) is already reached."""
    if not len(points):
        return
    bounds, children, spans = tree.bounds(queries), tree.child.tolist(), tree.span.tolist()
    for q in range(len(queries)):
        bound, kth = bounds[q], floor[q]
        best_ids, best = np.zeros(0, np.int64), np.zeros(0)
        heap = [(-bound[0], 0)]
        while heap:
            # Open nodes in the order of their bounds; leaves that must be read are read together
            # as long as they follow each other at the top.
            top, node = heapq.heappop(heap)
            if -top < kth:
                break
            child = children[node]
            if child[0] >= 0:
                for c in child:
                    if bound[c] >= kth:
                        heapq.heappush(heap, (-bound[c], c))
                continue
            a, b = spans[node]
            score = points[a:b] @ queries[q]
            pick = np.flatnonzero((score >= kth) & (ids[a:b] != query_ids[q]))
            if len(pick):
                best = np.concatenate((best, score[pick]))
                best_ids = np.concatenate((best_ids, ids[a:b][pick]))
                if len(best) > k:
                    keep = np.lexsort((best_ids, -best))[:k]
                    best, best_ids = best[keep], best_ids[keep]
                if len(best) == k:
                    kth = max(kth, best.min())
        if len(best):
            yield query_ids[q], best_ids, best


def _search(k: int):
    """Pairs of a packed shard and a packed query block with floors -> found rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                ids, points = _unpack(row["ids"], row["vectors"], row["dim"])
                query_ids, queries = _unpack(row["q_ids"], row["q_vectors"], row["dim"])
                tree = KdTree.load(row["tree"], row["dim"])
                floor = np.full(len(query_ids), -np.inf)
                if row["floors"] is not None:
                    for i, x in zip(*(np.frombuffer(row["floors"], "<i8").reshape(2, -1)), strict=True):
                        floor[query_ids == i] = x
                out = [(np.full(len(i), q), i, s) for q, i, s in
                       search(tree, ids, points, query_ids, queries, k, floor)]
                if out:
                    q, i, s = (np.concatenate(x) for x in zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(q.astype(np.int64)), pa.array(i.astype(np.int64)),
                         pa.array(s.astype(np.int64))], ["query_id", "vec_id", "score"])
    return run


def _floors(k: int):
    """A block's first results -> its queries' k-th scores, packed (ids, then scores)."""
    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        q, s = t.column("query_id").to_numpy(), t.column("score").to_numpy()
        order = np.lexsort((-s, q))
        q, s = q[order], s[order]
        first = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1])))
        full = first[np.diff(np.concatenate((first, [len(q)]))) >= k]
        packed = np.concatenate((q[full], s[full + k - 1])).astype("<i8").tobytes()
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()),
                         "block": pa.array([key[1].as_py()], pa.int32()), "floors": [packed]})
    return run


def top_k(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows whose id is divisible by ``every``."""
    small_batches(vectors.sparkSession)
    rows = written(quantised(vectors), "kd-vectors")
    per = rows.count()
    shards = max(1, -(-per // SHARD_ROWS))
    blocks = max(1, -(-per // (every * BLOCK_ROWS)))
    # A place, not the id, names the shard: an id may stand in very many rows.
    dealt = with_places(rows).withColumn("shard", F.pmod(F.xxhash64("__file", "__row"), F.lit(shards)).cast("int"))
    store = written(dealt.groupBy("dim", "shard").applyInArrow(_store, STORED), "kd-shards").drop("n")
    asked = rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "dim", "v"])
    asked = asked.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int"))
    asked = asked.groupBy("dim", "shard").applyInArrow(_pack, PACKED)
    asked = written(asked.select("dim", F.col("shard").alias("block"), F.col("ids").alias("q_ids"),
                                 F.col("vectors").alias("q_vectors")), "kd-queries")
    best, done = None, 0
    order = Window.partitionBy("query_id", "dim", "block").orderBy(F.desc("score"), "vec_id")
    while done < shards:
        some = min(shards - done, max(1, ROUND_GROWTH * done))
        visits = asked.withColumn("shard", F.explode(F.sequence(F.lit(done), F.lit(done + some - 1))))
        visits = visits.withColumn("shard", F.pmod(F.col("shard") + F.col("block"), F.lit(shards)).cast("int"))
        if best is None:
            visits = visits.withColumn("floors", F.lit(None).cast("binary"))
        else:
            floors = best.groupBy("dim", "block").applyInArrow(_floors(k), "dim int, block int, floors binary")
            visits = visits.join(written(floors, "kd-floors"), ["dim", "block"], "left")
        pairs = visits.join(store, ["dim", "shard"]).select(
            "dim", "block", "shard", "ids", "vectors", "tree", "q_ids", "q_vectors", "floors")
        found = pairs.mapInArrow(_tagged(_search(k)), "dim int, block int, " + FOUND)
        if best is not None:
            found = found.union(best)
        found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank")
        best, former = written(found, "kd-best"), best
        if former is not None:
            discard(former)
        done += some
    # An id may ask with several vectors, in several blocks.
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _tagged(inner):
    """``inner`` row by row, with the dimension and block of the row it came from."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                dim, block = one.column(0)[0].as_py(), one.column(1)[0].as_py()
                for out in inner(iter([one])):
                    n = out.num_rows
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([dim] * n, pa.int32()), pa.array([block] * n, pa.int32()), *out.columns],
                        ["dim", "block", "query_id", "vec_id", "score"])
    return run


def contract(vectors: DataFrame) -> DataFrame:
    return top_k(vectors, k=5, every=50)
