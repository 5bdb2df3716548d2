"""Hard-negative mining over an inverted multi-index.

The vectors are cut in two halves; each half has a codebook (k-means on a bounded sample of ``SAMPLE`` rows), and a row
lies in the cell of its two nearest codewords.  The rows of a first codeword, dealt to shards of some ``SHARD_ROWS``, are a
part; the directory tells each cell's number of rows and, for each half, its radius: the largest distance of a row from
the codeword.  It holds one entry for each pair of codewords, at most ``CODEWORDS``**2 for each dimension of the sample
and one for any other dimension, so it is broadcast.

By Cauchy-Schwarz the inner product of a query q with the rows of a cell is at most, summed over the halves,
``q . codeword + |q| * radius``, and at least the same with a minus.  A heap visits the cells of a query in the order of
the summed upper bounds (multi-sequence), and a row is scored exactly, in whole numbers.

1. Positives.  A first round visits the first cells with ``FIRST_ROWS`` rows; the k-th best score that it finds is a proven
   limit, and the second round visits every other cell whose bound reaches it.
2. Windows.  The same with the cells whose bounds meet a window of scores: the third best row found in a window, or the
   window's lower end, is the limit of the second round.  When both rounds are over, every window is certified.

A query is sent once to each part that holds one of its cells; a task holds the rows of one part and lets queries pass.

Defined results: rows with a null vec_id, label or vector, or any null or non-finite component (also after scaling) take no
part; vectors of different dimensions are not compared; rows that share a vec_id are different rows; an anchor without
another row of its label, or without a row in a window, has no result there; a score that does not fit 64 bits is an
error; an empty table gives no rows; only vec_id, embedding and label are read, other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.session import checkpoint_table

EVERY = 50
POSITIVES, NEGATIVES = 5, 3
#: A negative's score in percent of the positive's, from and to.
LOW, HIGH = 50, 95
SCALE = 256.0
SAMPLE = 20_000
CODEWORDS = 256
#: Rows of a cell that the number of codewords aims at, rows of a part, and rows that a first round looks at.
CELL_ROWS, SHARD_ROWS, FIRST_ROWS = 64, 4096, 512
#: Queries scored at once, and sums of products that doubles hold exactly.
BLOCK, EXACT = 256, 2.0 ** 53
PART = ["dim", "c1", "shard"]


def usable(table: DataFrame, scale: float = SCALE) -> DataFrame:
    """(row, vec_id, label, vector, dim) of the rows that take part, with whole components."""
    v = F.transform(F.col("embedding"), lambda x: x.cast("double") * scale)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = table.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
                        F.col("label").cast("long").alias("label"), v.alias("vector"), bad.alias("bad"))
    rows = rows.filter("vec_id is not null and label is not null and vector is not null and not coalesce(bad, true)")
    # floor() would give a long
    part = F.transform("vector", lambda x: F.when(F.rint(x) > x, F.rint(x) - 1).otherwise(F.rint(x)))
    return rows.select("row", "vec_id", "label", part.alias("vector"), F.size("vector").alias("dim"))


def fit(half: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """k-means codewords, starting at ``k`` rows drawn with a fixed seed."""
    rng = np.random.default_rng(7)
    words = half[np.sort(rng.choice(len(half), min(k, len(half)), replace=False))].copy()
    for _ in range(rounds):
        own = nearest(half, words)
        sums = np.zeros_like(words)
        np.add.at(sums, own, half)
        n = np.bincount(own, minlength=len(words))
        words[n > 0] = sums[n > 0] / n[n > 0, None]
    return words


def nearest(half: np.ndarray, words: np.ndarray) -> np.ndarray:
    # a finite scale keeps squares of huge components from overflowing
    most = max(1.0, float(np.abs(half).max(initial=0.0)), float(np.abs(words).max(initial=0.0)))
    a, b = half / most, words / most
    return np.argmin((b * b).sum(axis=1) - 2 * (a @ b.T), axis=1)


def norms(x: np.ndarray) -> np.ndarray:
    most = np.abs(x).max(axis=-1, initial=0.0)
    safe = np.where(most > 0, most, 1.0)
    return np.sqrt(((x / safe[..., None]) ** 2).sum(axis=-1)) * most


def codebooks(rows: DataFrame, sample: int = SAMPLE, most: int = CODEWORDS) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each dimension of a bounded sample the codewords of the two halves."""
    n = rows.count()
    k = int(min(most, max(1, np.ceil(np.sqrt(n / CELL_ROWS)))))
    some = rows.select("vector", "dim", F.xxhash64("row").alias("h"), "row").orderBy("h", "row").limit(sample).toPandas()
    books = {}
    for dim, own in some.groupby("dim"):
        x = np.stack(own["vector"].to_numpy()).astype(np.float64)
        books[int(dim)] = (fit(x[:, :dim // 2], k), fit(x[:, dim // 2:], k))
    return books


def book_of(books: dict, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """A dimension that the sample lacks has one codeword, the origin."""
    return books.get(dim) or (np.zeros((1, dim // 2)), np.zeros((1, dim - dim // 2)))


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def assign(rows: DataFrame, books: dict) -> DataFrame:
    """``rows`` with the cell (c1, c2) and the distances d1, d2 from its codewords."""
    held = rows.sparkSession.sparkContext.broadcast(books)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = pa.Table.from_batches([batch])
            dims = t.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = t.filter(pa.array(dims == dim))
                x, (w1, w2) = _matrix(part.column("vector"), dim), book_of(held.value, int(dim))
                for i, (half, words) in enumerate(((x[:, :dim // 2], w1), (x[:, dim // 2:], w2)), 1):
                    own = nearest(half, words)
                    part = part.append_column(f"c{i}", pa.array(own.astype(np.int32)))
                    part = part.append_column(f"d{i}", pa.array(norms(half - words[own])))
                yield from part.combine_chunks().to_batches()

    return rows.mapInArrow(make, "row long, vec_id long, label long, vector array<double>, dim int, "
                                 "c1 int, d1 double, c2 int, d2 double")


class Directory:
    """Codewords of a dimension, and rows and radii of its cells."""

    def __init__(self, words: tuple[np.ndarray, np.ndarray], cells: list[tuple[int, int, int, float, float]]):
        self.words = words
        shape = len(words[0]), len(words[1])
        self.count = np.zeros(shape, np.int64)
        self.radius = np.zeros((2, *shape))
        for c1, c2, n, d1, d2 in cells:
            self.count[c1, c2] = n
            self.radius[:, c1, c2] = d1, d2
        self.widest = self.radius[0].max(axis=1), self.radius[1].max(axis=0)

    def bounds(self, query: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Upper half-score bounds of the codewords, and upper and lower bounds of the cells; rounding included."""
        cut = len(self.words[0][0])
        halves = query[:cut], query[cut:]
        size = [float(norms(h[None])[0]) for h in halves]
        score = [w @ h for w, h in zip(self.words, halves)]
        slack = [1e-9 * s * (float(norms(w).max()) + float(r.max()) + 1) + 1e-6
                 for s, w, r in zip(size, self.words, self.widest)]
        upper = [s + n * r + e for s, n, r, e in zip(score, size, self.widest, slack)]
        middle = score[0][:, None] + score[1][None, :]
        wide = size[0] * self.radius[0] + size[1] * self.radius[1] + sum(slack)
        return upper, middle + wide, middle - wide

    def visit(self, upper: list[np.ndarray]) -> Iterator[tuple[float, int, int]]:
        """Multi-sequence heap: the cells (bound, c1, c2) by falling sum of their half-score bounds."""
        first, second = (np.argsort(-u, kind="stable") for u in upper)
        a, b = upper[0][first].tolist(), upper[1][second].tolist()
        first, second = first.tolist(), second.tolist()
        heap = [(-(a[0] + b[0]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            yield -bound, first[i], second[j]
            if j + 1 < len(b):
                heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))

    def cells(self, query: np.ndarray, low: list[int], high: list[int], first: bool, rows: int) -> list[tuple[int, int]]:
        """The cells of a round: those that can hold a score of one of the windows [low, high].

        The cells before ``rows`` rows have been met are the first round; ``low`` may rise for the second.
        """
        windows = [(lo, hi) for lo, hi in zip(low, high) if lo <= hi]
        if not windows:
            return []
        upper, most, least = self.bounds(query)
        # which cells the first round takes must not depend on limits found since, so it takes any that a window's end meets
        end = max(hi for _, hi in windows)
        out, met, floor = [], 0, min(lo for lo, _ in windows)
        for bound, c1, c2 in self.visit(upper):
            if not first and bound < floor:
                break
            if not self.count[c1, c2] or least[c1, c2] > end:
                continue
            early, met = met < rows, met + int(self.count[c1, c2])
            if first and not early:
                break
            if early == first and (first or any(most[c1, c2] >= lo and least[c1, c2] <= hi for lo, hi in windows)):
                out.append((c1, c2))
        return out


class Index:
    """The parts as a written table, and a broadcast directory."""

    def __init__(self, rows: DataFrame, shard_rows: int = SHARD_ROWS, sample: int = SAMPLE, codewords: int = CODEWORDS):
        books = codebooks(rows, sample, codewords)
        placed = checkpoint_table(assign(rows, books), "negatives")
        cells: dict[int, list] = {}
        for dim, *cell in placed.groupBy("dim", "c1", "c2").agg(
                F.count(F.lit(1)), F.max("d1"), F.max("d2")).collect():  # at most a row for each pair of codewords
            cells.setdefault(dim, []).append(cell)
        directory = {d: Directory(book_of(books, d), c) for d, c in cells.items()}
        self.shards = {(d, c1): -(-int(n) // shard_rows) for d, x in directory.items()
                       for c1, n in enumerate(x.count.sum(axis=1)) if n}
        self.directory = rows.sparkSession.sparkContext.broadcast((directory, self.shards))
        of = rows.sparkSession.createDataFrame([(*k, n) for k, n in self.shards.items()] or [(0, 0, 1)],
                                               "dim int, c1 int, shards int")
        self.parts = placed.join(F.broadcast(of), ["dim", "c1"]).withColumn(
            "shard", F.pmod(F.xxhash64("row"), F.col("shards")).cast("int")).drop("shards", "d1", "d2")

    def visits(self, queries: DataFrame, first: bool, first_rows: int = FIRST_ROWS) -> DataFrame:
        """A row for each part that a query (row, label, vector, dim, low, high) visits, with the cells there."""
        held = self.directory

        def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            directory, shards = held.value
            for b in batches:
                out = []
                for row, label, vector, dim, low, high in b.itertuples(index=False):
                    by: dict[int, list[int]] = {}
                    for c1, c2 in directory[dim].cells(vector, list(low), list(high), first, first_rows):
                        by.setdefault(c1, []).append(c2)
                    out += [(dim, c1, s, row, label, vector, c2, low, high)
                            for c1, c2 in by.items() for s in range(shards[dim, c1])]
                yield pd.DataFrame(out, columns=[*PART, "row", "label", "vector", "cells", "low", "high"])

        return queries.select("row", "label", "vector", "dim", "low", "high").mapInPandas(
            make, "dim int, c1 int, shard int, row long, label long, vector array<double>, cells array<int>, "
                  "low array<long>, high array<long>")

    def scan(self, visits: DataFrame, same: bool, k: int) -> DataFrame:
        """(query, window, score, vec_id, row): the k best rows that each part has for each window of a query; rows of its
        label other than its own (``same``), or rows of other labels."""
        none = F.lit(None)
        rows = self.parts.select(*PART, F.lit(0).alias("kind"), "row", "vec_id", "label", "vector", "c2",
                                 none.cast("array<int>").alias("cells"), none.cast("array<long>").alias("low"),
                                 none.cast("array<long>").alias("high"))
        asked = visits.select(*PART, F.lit(1).alias("kind"), "row", none.cast("long").alias("vec_id"), "label", "vector",
                              none.cast("int").alias("c2"), "cells", "low", "high")
        dealt = rows.union(asked).repartition(*PART).sortWithinPartitions(*PART, "kind", "c2", "vec_id")

        def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            here, part = None, None
            for batch in batches:
                t = pa.Table.from_batches([batch])
                keys = np.stack([t.column(c).to_numpy() for c in (*PART, "kind")])
                cuts = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)]) if len(t) else []
                for s, e in zip(cuts, [*cuts[1:], len(t)]):
                    key, own = tuple(keys[:3, s].tolist()), t.slice(s, e - s)
                    if key != here:
                        here, part = key, Part(key[0])
                    if keys[3, s] == 0:
                        part.add(own)
                    else:
                        for at in range(0, len(own), BLOCK):
                            yield part.best(own.slice(at, BLOCK), same, k)

        return dealt.mapInArrow(make, "query long, window int, score long, vec_id long, row long")


class Part:
    """The rows of a part, by cell and vec_id."""

    def __init__(self, dim: int):
        self.dim, self.pieces = dim, []

    def add(self, rows: pa.Table) -> None:
        self.pieces.append(rows.select(["row", "vec_id", "label", "vector", "c2"]))

    def _load(self) -> None:
        if self.pieces:
            t = pa.concat_tables(self.pieces).combine_chunks()
            self.row, self.vec_id, self.label, self.c2 = (t.column(c).to_numpy() for c in ("row", "vec_id", "label", "c2"))
            self.vectors = _matrix(t.column("vector"), self.dim)
            self.most = float(np.abs(self.vectors).max(initial=0.0))
            self.pieces = []

    def scores(self, some: np.ndarray, queries: np.ndarray) -> np.ndarray:
        """Exact inner products (queries x rows); of Python's whole numbers where doubles could round."""
        rows = self.vectors[some]
        if self.most * float(np.abs(queries).max(initial=0.0)) * max(self.dim, 1) < EXACT:
            return queries @ rows.T
        whole = np.vectorize(int, otypes=[object])
        return whole(queries) @ whole(rows).T

    def best(self, asked: pa.Table, same: bool, k: int) -> pa.RecordBatch:
        self._load()
        cells = asked.column("cells").to_pylist()
        some = np.flatnonzero(np.isin(self.c2, sorted({c for x in cells for c in x})))
        vec_id, label, row, c2 = self.vec_id[some], self.label[some], self.row[some], self.c2[some]
        scores = self.scores(some, _matrix(asked.column("vector"), self.dim))
        found = []
        for score, q, own_cells, l, low, high in zip(scores, asked.column("row").to_pylist(), cells,
                                                     *(asked.column(c).to_pylist() for c in ("label", "low", "high"))):
            # each round sees its own cells, so that no row is found twice
            fits = np.isin(c2, own_cells) & ((label == l) & (row != q) if same else label != l)
            for window, (lo, hi) in enumerate(zip(low, high)):
                own = np.flatnonzero(fits & (score >= lo) & (score <= hi))
                if len(own) > k:
                    if score.dtype != object:
                        limit = np.partition(score[own], len(own) - k)[len(own) - k]
                        own = own[score[own] >= limit]
                    own = np.array(sorted(own.tolist(), key=lambda i: (-score[i], vec_id[i], row[i]))[:k])
                found += [(q, window, int(score[i]), vec_id[i], row[i]) for i in own.tolist()]
        columns = list(zip(*found)) if found else [[]] * 5
        kinds = pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                          ["query", "window", "score", "vec_id", "row"])


def first_of(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query", "window").orderBy(F.col("score").desc(), "vec_id", "row"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k)


def certified(index: Index, queries: DataFrame, same: bool, k: int, first_rows: int = FIRST_ROWS) -> DataFrame:
    """The k best rows in each window [low, high] of each query (row, label, vector, dim, low, high), in two rounds."""
    early = checkpoint_table(first_of(index.scan(index.visits(queries, True, first_rows), same, k), k), "negatives")
    reached = early.filter(F.col("rank") == k).groupBy("query").agg(
        F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("reached"))
    limit = F.transform("low", lambda lo, i: F.coalesce(F.try_element_at("reached", i), lo))
    rest = queries.join(reached, queries["row"] == reached["query"], "left").select(
        "row", "label", "vector", "dim", limit.alias("low"), "high")
    late = index.scan(index.visits(rest, False, first_rows), same, k)
    return first_of(early.drop("rank").union(late), k)


def window_of(score: Column, low: int = LOW, high: int = HIGH) -> tuple[Column, Column]:
    """Smallest and largest whole negative score for a positive's."""
    s = score.cast("decimal(20,0)")
    return F.ceil(low * s / 100).cast("long"), F.floor(high * s / 100).cast("long")


def relabelled(label: Column, vec_id: Column) -> Column:
    """The contract's labels: where vec_id is divisible by 7 the next of ten."""
    return F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)


def hard_negatives(table: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, first_rows: int = FIRST_ROWS, **sizes) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows whose vec_id is divisible by
    ``every``."""
    rows = checkpoint_table(usable(table), "negatives")
    index = Index(rows, **sizes)
    far = 2 ** 63 - 1
    anchors = rows.filter(F.col("vec_id") % every == 0)
    near = checkpoint_table(certified(
        index, anchors.withColumns({"low": F.array(F.lit(-far)), "high": F.array(F.lit(far))}), True, positives,
        first_rows), "negatives")
    lo, hi = window_of(F.col("score"), low, high)
    near = near.select(F.col("query").alias("anchor"), (F.col("rank") - 1).alias("window"),
                       F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
                       lo.alias("lo"), hi.alias("hi"))
    windows = near.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("window", "lo", "hi"))).alias("w"))
    asked = anchors.join(windows, anchors["row"] == windows["anchor"]).select(
        "row", "label", "vector", "dim", F.col("w.lo").alias("low"), F.col("w.hi").alias("high"))
    found = certified(index, asked, False, negatives, first_rows).withColumnRenamed("vec_id", "negative_id")
    found = found.join(near, (found["query"] == near["anchor"]) & (found["window"] == near["window"]))
    return found.join(anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score",
        F.col("score").alias("negative_score"))
