"""Exact top-k search by inner product with a KD-tree for each shard of the vectors.

Shards are the leaves of a coarse tree, split further by hash where a leaf holds many rows. Each shard's own tree splits at
the median of the widest dimension and keeps tight bounding boxes. A query walks a tree best first: the box with the highest
bound on the inner product comes next, and the walk ends when that bound is below the query's k-th score so far. A first
pass over each query's home shard gives every query a k-th score; the second pass takes it only to the shards whose box
can reach that score. Trees are built once in a pass, and queries stream through them.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridprep.llm.common import cut, small_batches, with_rows

LEAF = 128
#: Vectors in a shard, about, as long as that makes no more than MAX_SHARDS of them, whose boxes every task gets.
SHARD_ROWS, MAX_SHARDS = 8_192, 32_768
#: Vectors that the coarse tree is fitted on (any tree gives the same results), and leaves it has at most.
SAMPLE_ROWS, COARSE = 16_384, 512
_LOWEST = -(1 << 63)


class KDTree:
    """Nodes in arrays: children (or -1), the rows ``start:end`` of ``order``, and the box ``low``, ``high``."""

    def __init__(self, vectors: np.ndarray, leaf: int = LEAF) -> None:
        self.order = np.arange(len(vectors))
        self.left, self.right, self.start, self.end, low, high = [], [], [], [], [], []
        #: Where inner nodes split: values of dimension ``axis`` below ``at`` go left.
        self.axis, self.at = [], []
        todo = [(0, len(vectors), -1, False)]
        while todo:
            a, b, parent, is_right = todo.pop()
            own = vectors[self.order[a:b]]
            me = len(self.start)
            if parent >= 0:
                (self.right if is_right else self.left)[parent] = me
            low.append(own.min(0))
            high.append(own.max(0))
            for x, v in ((self.left, -1), (self.right, -1), (self.start, a), (self.end, b), (self.axis, 0), (self.at, 0)):
                x.append(v)
            width = high[-1] - low[-1]
            if b - a > leaf and width.size and width.max() > 0:
                axis, mid = int(width.argmax()), (b - a) // 2
                self.order[a:b] = self.order[a:b][np.argpartition(own[:, axis], mid)]
                self.axis[me], self.at[me] = axis, vectors[self.order[a + mid], axis]
                todo += [(a, a + mid, me, False), (a + mid, b, me, True)]
        self.low, self.high = np.array(low), np.array(high)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The highest inner product any point of each node's box can have with each query."""
        return _reach(queries, self.low, self.high)

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The node that each vector comes to by the splits."""
        left, right, axis, at = (np.array(x) for x in (self.left, self.right, self.axis, self.at))
        node = np.zeros(len(vectors), np.int64)
        while True:
            inner = np.flatnonzero(left[node] >= 0)
            if not len(inner):
                return node
            own = node[inner]
            node[inner] = np.where(vectors[inner, axis[own]] < at[own], left[own], right[own])


def _reach(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T


def _exact(*parts: np.ndarray) -> type:
    """Doubles where all sums of products stay below 2^53, else 64-bit integers."""
    most = [float(np.abs(p).max()) if p.size else 0.0 for p in parts]
    return np.float64 if most[0] * most[1] * max(p.shape[1] for p in parts) < 2**53 else np.int64


class Shard:
    """A shard's vectors in the order of its tree."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.tree = KDTree(vectors)
        self.rows, self.ids, self.vectors = (x[self.tree.order] for x in (rows, ids, vectors))

    def search(self, own: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query its up to k best (id, score) in other rows than ``own``, of its floor or more; ties: smaller id."""
        kind = _exact(self.vectors, queries)
        vectors, queries, tree = self.vectors.astype(kind), queries.astype(kind), self.tree
        bounds = _reach(queries, tree.low.astype(kind), tree.high.astype(kind))
        for i, q in enumerate(queries):
            floor = int(floors[i])
            got_ids, got = np.zeros(0, np.int64), np.zeros(0, kind)
            heap = [(-bounds[i, 0], 0)]
            while heap:
                bound, node = heapq.heappop(heap)
                if -bound < floor:
                    break
                if tree.left[node] >= 0:
                    for child in (tree.left[node], tree.right[node]):
                        if bounds[i, child] >= floor:
                            heapq.heappush(heap, (-bounds[i, child], child))
                    continue
                a, b = tree.start[node], tree.end[node]
                score = vectors[a:b] @ q
                new = np.flatnonzero((score >= floor) & (self.rows[a:b] != own[i]))
                if len(new):
                    got_ids, got = np.concatenate((got_ids, self.ids[a:b][new])), np.concatenate((got, score[new]))
                    if len(got) > k:
                        best = np.lexsort((got_ids, -got))[:k]
                        got_ids, got = got_ids[best], got[best]
                    if len(got) == k:
                        floor = max(floor, int(got.min()))
            yield i, got_ids, got


def quantised(vector: Column | str, scale: int = 256) -> Column:
    """floor(scale * x) of every component as an integer array; null if a component is null or not finite, or the array is."""
    v = F.col(vector) if isinstance(vector, str) else vector
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.when(fine, F.transform(v, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")))


def _matrix(v: pd.Series) -> np.ndarray:
    return np.array(v.tolist(), np.int64).reshape(len(v), -1)


FOUND = "query_row long, query_id long, vec_id long, score long"


def _searched(k: int):
    """Rows of shards in turn, each one's vectors before the queries that come to it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        key = shard = None
        for pdf in batches:
            for own, group in pdf.groupby(["shard", "asks"], sort=False):
                if own[0] != key:
                    key, shard, held = own[0], None, []
                rows, ids, v = group["row"].to_numpy(np.int64), group["vec_id"].to_numpy(np.int64), _matrix(group["v"])
                if not own[1]:
                    held.append((rows, ids, v))
                    continue
                if held:
                    shard, held = Shard(*(np.concatenate(x) for x in zip(*held, strict=True))), []
                if shard:
                    found = [(np.full(len(b), i), b, c) for i, b, c in shard.search(rows, v, group["floor"].to_numpy(np.int64), k)]
                    which, vec, score = (np.concatenate(x).astype(np.int64) for x in zip(*found, strict=True))
                    yield pd.DataFrame({"query_row": rows[which], "query_id": ids[which], "vec_id": vec, "score": score})

    return run


def _boxes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for key, group in pdf.groupby("shard", sort=False):
            v = _matrix(group["v"])
            yield pd.DataFrame({"shard": [key], "n": [len(v)], "low": [v.min(0)], "high": [v.max(0)]})


def _merged(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"shard": pdf["shard"].iloc[:1], "low": [_matrix(pdf["low"]).min(0)], "high": [_matrix(pdf["high"]).max(0)]})


def _reaching(shared):
    """Each query for each shard, but its home, whose box can reach its floor."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        boxes = {dim: (shards, low, high) for dim, shards, low, high in shared.value}
        for pdf in batches:
            for dim, group in pdf.groupby("dim", sort=False):
                if dim not in boxes:
                    continue
                shards, low, high = boxes[dim]
                v, floors = _matrix(group["v"]), group["floor"].to_numpy(np.int64)
                kind = _exact(np.concatenate((low, high)), v)
                reach = _reach(v.astype(kind), low.astype(kind), high.astype(kind))
                i, j = np.nonzero((reach >= floors[:, None]) & (shards[None, :] != group["home"].to_numpy(np.int64)[:, None]))
                for a in range(0, len(i), 10_000):
                    out = group.iloc[i[a : a + 10_000]][["row", "vec_id", "v", "floor"]]
                    yield out.assign(shard=shards[j[a : a + 10_000]])

    return run


def top_k(vectors: DataFrame, asks: Column, k: int = 5, vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row for which ``asks`` holds the k highest inner products among the
    other rows of ``vectors`` (vec_id, ``vector``).

    Components become floor(256 * x). Ties go to the smaller vec_id. Rows with a null id, a null or empty vector, or a null
    or non-finite component take no part; a query only meets vectors of its own length. Rows that repeat a vec_id are rows
    of their own, candidates and queries. Fewer than k others: all of them. Scores beyond 64 bits aren't supported.
    """
    spark = vectors.sparkSession
    small_batches(spark, 2_000)
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), quantised(vector).alias("v"), F.coalesce(asks, F.lit(False)).alias("query"))
    own = with_rows(own.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)), "row").withColumn("dim", F.size("v"))
    total = own.count()
    shards = min(MAX_SHARDS, max(1, -(-total // SHARD_ROWS)))
    # a bounded sample for the coarse trees, one for each length of vectors
    sample = own.select("dim", "v").orderBy(F.xxhash64("row")).limit(SAMPLE_ROWS).toPandas()
    trees = {int(dim): KDTree(_matrix(g["v"]), max(1, -(-len(g) // max(1, min(COARSE, shards // 2))))) for dim, g in sample.groupby("dim")}

    @F.pandas_udf("long")
    def leaf(dim: pd.Series, v: pd.Series) -> pd.Series:
        out = np.zeros(len(v), np.int64)
        for d in dim.unique():
            at = np.flatnonzero(dim == d)
            if d in trees:
                out[at] = trees[d].leaves(_matrix(v.iloc[at]))
        return pd.Series(out)

    # leaves of many rows, such as those of one common vector, fall into parts by hash
    leaves = cut(own.withColumn("leaf", leaf("dim", "v")))
    rows_each = max(SHARD_ROWS, -(-total // MAX_SHARDS))
    sizes = leaves.groupBy("dim", "leaf").agg(F.count(F.lit(1)).alias("size"))
    keys = sizes.select("dim", "leaf", F.ceil(F.col("size") / rows_each).cast("long").alias("parts"))
    placed = leaves.join(keys, ["dim", "leaf"])
    shard = F.xxhash64("dim", "leaf", F.pmod(F.xxhash64("row"), F.col("parts")))
    placed = cut(placed.select("row", "vec_id", "v", "dim", "query", shard.alias("shard")))
    lowest = F.lit(_LOWEST).cast("long")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(asked: DataFrame) -> DataFrame:
        held = placed.select("shard", F.lit(False).alias("asks"), "row", "vec_id", "v", lowest.alias("floor"))
        both = held.unionByName(asked.select("shard", F.lit(True).alias("asks"), "row", "vec_id", "v", "floor"))
        return both.repartition(partitions, "shard").sortWithinPartitions("shard", "asks").mapInPandas(_searched(k), FOUND)

    asked = placed.filter("query")
    found = cut(run(asked.withColumn("floor", lowest)))
    boxes = placed.select("shard", "dim", "v").mapInPandas(_boxes, "shard long, n long, low array<long>, high array<long>")
    boxes = boxes.groupBy("shard").applyInPandas(_merged, "shard long, low array<long>, high array<long>").toPandas()
    if len(boxes) > 1:
        grouped = [(d, g["shard"].to_numpy(np.int64), _matrix(g["low"]), _matrix(g["high"])) for d, g in boxes.groupby(boxes["low"].map(len))]
        floors = found.groupBy("query_row").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
        floors = floors.select(F.col("query_row").alias("row"), F.when(F.col("n") >= k, F.col("least")).alias("least"))
        rest = asked.withColumnRenamed("shard", "home").join(floors, "row", "left").withColumn("floor", F.coalesce("least", lowest))
        sent = rest.select("row", "vec_id", "v", "dim", "home", "floor").mapInPandas(_reaching(spark.sparkContext.broadcast(grouped)), "row long, vec_id long, v array<long>, floor long, shard long")
        found = found.unionByName(run(sent))
    w = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
