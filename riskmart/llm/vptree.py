"""Nearest neighbours in vantage-point trees.

The vectors are dealt to shards of bounded size by a hash, one tree is built per shard, and each block of queries
searches every tree; a query's nearest are the nearest of what its shards return.  A tree node holds a vantage point;
the vectors of a node are split at the median distance to it, and each child keeps the smallest and largest distance.
By the triangle inequality a child is at least ``max(d - far, near - d)`` away from a query at distance d of the
vantage point.  It is pruned when ``factor`` times this bound is above the distance of the k-th nearest so far: factor 1
is exact search, a larger factor prunes more and may miss.

Vectors that are null, all zero, or hold a null or a non-finite component take no part; neither is a vector compared
with one of another dimension.  Ties go to the smaller vec_id.  A query is a row: another row with its vec_id is a
candidate.  A query with fewer candidates than k gets all of them; an empty table gives no rows; other columns are
ignored.  A null vec_id takes no part.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskmart.session import checkpoint_table

SHARD_ROWS = 8192
BLOCK_ROWS = 512
LEAF = 256
K = 10
FACTOR = 1.0


def distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances; ``vectors`` is dims x n, squares are added component by component, in order."""
    diff = vectors - query[:, None]
    return np.sqrt(np.add.accumulate(diff * diff, axis=0)[-1]) if len(query) else np.zeros(vectors.shape[1])


class Tree:
    """A vantage-point tree in arrays: nodes, and the vectors in leaf order (dims x n)."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF):
        order = np.lexsort((rows, ids))
        self.vectors = np.ascontiguousarray(vectors[order].T, dtype=np.float64)
        # node: (first, end, vantage vector, [(child, nearest, farthest), ...]); leaves have no children
        self.nodes: list[tuple] = []
        place = np.arange(len(order))
        self._build(place, 0, len(place), leaf)
        self.ids, self.rows = ids[order][place], rows[order][place]
        self.vectors = np.ascontiguousarray(self.vectors[:, place])
        self.squares = (self.vectors * self.vectors).sum(axis=0)

    def _build(self, place: np.ndarray, first: int, end: int, leaf: int) -> int:
        number = len(self.nodes)
        self.nodes.append((first, end, None, ()))
        if end - first > leaf:
            own = place[first:end]
            vantage = self.vectors[:, own[0]].copy()
            far = distances(self.vectors[:, own], vantage)
            by = np.argsort(far, kind="stable")
            place[first:end], far = own[by], far[by]
            half = (end - first) // 2
            if far[0] < far[-1]:
                children = tuple(
                    (self._build(place, first + a, first + b, leaf), far[a], far[b - 1])
                    for a, b in ((0, half), (half, end - first)))
                self.nodes[number] = (first, end, vantage, children)
        return number

    def search(self, query: np.ndarray, own_row: int, k: int, factor: float) -> list[tuple[float, int]]:
        """The k nearest (distance, id), without the query's own row; nodes in the order of their bounds."""
        found: list[tuple[float, int]] = []
        limit, square = np.inf, float(query @ query)
        heap = [(0.0, 0)]
        while heap:
            bound, number = heapq.heappop(heap)
            # rounding must not prune a tie
            if bound * factor > limit * (1 + 1e-9) + 1e-12:
                break
            first, end, vantage, children = self.nodes[number]
            if children:
                d = float(distances(vantage[:, None], query)[0])
                for child, near, far in children:
                    # squares of huge components overflow; an infinite distance bounds nothing
                    least = [x for x in (d - far, near - d) if math.isfinite(x)]
                    heapq.heappush(heap, (max(bound, *least), child) if least else (bound, child))
                continue
            # products tell, but for rounding, which vectors can be near enough; only these are measured
            both = self.squares[first:end] + square
            rough = both - 2 * (query @ self.vectors[:, first:end])
            # a product that is no number tells nothing, so its vector is measured
            some = np.flatnonzero(~(rough > limit * limit + 1e-9 * both) & (self.rows[first:end] != own_row)) + first
            if len(some):
                found += zip(distances(self.vectors[:, some], query).tolist(), self.ids[some].tolist())
                found = heapq.nsmallest(k, found)
                if len(found) == k:
                    limit = found[-1][0]
        return found


def usable(embedding: Column) -> Column:
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return embedding.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(embedding, lambda x: x != 0)


def build_index(vectors: DataFrame, shard_rows: int = SHARD_ROWS, leaf: int = LEAF) -> DataFrame:
    """(dim, shard, tree): a tree for each shard of the rows (row, vec_id, embedding as array<double>)."""
    n = vectors.count()
    shards = max(1, -(-n // shard_rows))
    dealt = vectors.select("row", "vec_id", "embedding", F.size("embedding").alias("dim"),
                           F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        tree = Tree(np.stack(group["embedding"].to_numpy()).astype(np.float64), group["vec_id"].to_numpy(np.int64),
                    group["row"].to_numpy(np.int64), leaf)
        return pd.DataFrame({"dim": group["dim"].iloc[:1], "shard": group["shard"].iloc[:1],
                             "tree": [pickle.dumps(tree, 5)]})

    return dealt.groupBy("dim", "shard").applyInPandas(build, "dim int, shard int, tree binary")


def search(index: DataFrame, queries: DataFrame, k: int = K, factor: float = FACTOR,
           block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, row, vec_id, score) with rank: the k nearest of each query (row, vec_id, embedding)."""
    n = queries.count()
    blocks = max(1, -(-n // block_rows))
    asked = queries.select(F.col("row").alias("q_row"), F.col("vec_id").alias("query_id"),
                           F.col("embedding").alias("query"), F.size("embedding").alias("dim"),
                           F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"))
    shards = index.select("dim", "shard", "tree")
    # every block of queries meets every shard of its dimension, one pair per group
    both = asked.join(shards.select("dim", "shard"), "dim")
    trees = shards.join(asked.select("dim", "block").distinct(), "dim").select(
        *[F.col(c).alias(f"t_{c}") for c in ("dim", "shard", "block", "tree")])

    def look(key: tuple, one: pd.DataFrame, group: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for blob in one["t_tree"]:
            tree = pickle.loads(blob)
            for row, query_id, query in zip(group["q_row"], group["query_id"], group["query"]):
                for d, vec_id in tree.search(np.asarray(query, np.float64), row, k, factor):
                    rows.append((query_id, row, vec_id, d))
        return pd.DataFrame(rows, columns=["query_id", "q_row", "vec_id", "score"])

    near = trees.groupBy("t_dim", "t_shard", "t_block").cogroup(both.groupBy("dim", "shard", "block")).applyInPandas(
        look, "query_id long, q_row long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("q_row").orderBy("score", "vec_id"))
    return near.withColumn("rank", place).filter(F.col("rank") <= k)


def neighbours(table: DataFrame, every: int = 100, k: int = K, factor: float = FACTOR,
               shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: for the rows whose vec_id is divisible by ``every`` the k nearest other rows."""
    rows = checkpoint_table(table.select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding")).filter(
        usable(F.col("embedding")) & F.col("vec_id").isNotNull()), "vptree")
    index = checkpoint_table(build_index(rows, shard_rows), "vptree")
    return search(index, rows.filter(F.col("vec_id") % every == 0), k, factor).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
