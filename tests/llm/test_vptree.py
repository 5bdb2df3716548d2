"""VP-trees: factor 1 equals brute force with ties, pruned search keeps its recall, edge cases."""

import numpy as np
import pytest

from llm_data import SF01

from riskmart.llm import vptree
from riskmart.llm.common import table


def brute(rows, every, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v
            and np.isfinite(v).all() and any(v)]
    out = {}
    for at, (q, a) in enumerate(good):
        if q % every == 0:
            near = sorted((float(np.sqrt(np.add.accumulate((a - b) ** 2)[-1])), i) for j, (i, b) in enumerate(good)
                          if j != at and len(b) == len(a))
            out.setdefault(q, []).append(near[:k])
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    return out


@pytest.mark.parametrize("shard", [20, 100_000])
def test_factor_one_is_exact(spark, shard):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(0, 4, 5)]) for i in range(300)]  # many ties
    rows += [(1000, None), (1001, [0.0] * 5), (1002, [1.0, None, 0.0, 0.0, 0.0]), (1003, [float("nan")] + [1.0] * 4),
             (1004, [float("inf")] + [1.0] * 4), (None, [1.0] * 5), (2000, [1.0, 2.0]), (2001, [1.0, 2.5])]
    df = spark.createDataFrame([r + (1, 2) for r in rows], "vec_id long, embedding array<double>, row int, dim int").repartition(4)
    got = found(vptree.neighbours(df, 10, 7, 1.0, shard))
    assert got == {q: n[0] for q, n in brute(rows, 10, 7).items() if n[0]}


def test_embeddings_and_pruned_recall(spark):
    df = table(spark, SF01, "embeddings")
    want = brute([(r["vec_id"], r["embedding"]) for r in df.collect()], 50, 10)
    exact = found(vptree.neighbours(df, 50))
    assert {q: [i for _, i in n] for q, n in exact.items()} == {q: [i for _, i in n[0]] for q, n in want.items()}
    loose = found(vptree.neighbours(df, 50, factor=1.5, shard_rows=100))
    hits = sum(len({i for _, i in loose[q]} & {i for _, i in n[0]}) for q, n in want.items())
    assert hits >= 0.9 * sum(len(n[0]) for n in want.values())


def test_repeated_vec_ids_are_rows(spark):
    df = spark.createDataFrame([(100, [1.0, 0.0]), (100, [1.0, 0.0]), (7, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = vptree.neighbours(df).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == [(100, 1, 100), (100, 1, 100), (100, 2, 7), (100, 2, 7)]


def test_empty(spark):
    assert vptree.neighbours(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    one = spark.createDataFrame([(100, [1.0])], "vec_id long, embedding array<float>")
    assert vptree.neighbours(one).count() == 0


def test_huge_components(spark):
    """Squares of components above 1e154 overflow; candidates stay candidates."""
    rng = np.random.default_rng(4)
    vectors = [[float(x) for x in v] for v in rng.normal(size=(30, 3))]
    vectors += [[float(x) for x in 1e155 + 1e150 * v] for v in rng.normal(size=(15, 3))]
    vectors += [[float(x) for x in 1e200 * v] for v in rng.normal(size=(15, 3))]
    rows = list(enumerate(vectors))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = {q: n[0] for q, n in brute(rows, 1, 10).items()}
    assert found(vptree.neighbours(df, 1, 10)) == want
    tree = vptree.Tree(np.array(vectors), np.arange(60), np.arange(60), 4)
    assert {i: sorted(tree.search(np.array(v), i, 10, 1.0)) for i, v in rows} == want
