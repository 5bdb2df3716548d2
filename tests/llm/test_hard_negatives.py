"""Hard negatives: brute force with ties, small cells and rounds, bounds that hold, edge cases."""

import math

import numpy as np
import pytest

from riskmart.llm import hard_negatives as H

NAN, INF = float("nan"), float("inf")


def brute(rows, every=50, positives=5, negatives=3, low=50, high=95):
    good = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows
            if i is not None and label is not None and v is not None and None not in v and np.isfinite(v).all()]
    out = []
    for at, (anchor, label, q) in enumerate(good):
        if anchor % every:
            continue
        near = sorted(((-sum(a * b for a, b in zip(q, v)), i, other) for j, (i, other, v) in enumerate(good)
                       if j != at and len(v) == len(q)), key=lambda x: x[:2])
        for s, positive, _ in [x for x in near if x[2] == label][:positives]:
            found = [x for x in near if x[2] != label and low * -s <= 100 * -x[0] <= high * -s][:negatives]
            out += [(anchor, positive, n, i, -s, -x) for n, (x, i, _) in enumerate(found, 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                       "negative_score")) for r in df.collect())


def frame(spark, rows):
    names = "vec_id long, label int, embedding array<double>, row int, dim int, query int, c1 string, cells int"
    return spark.createDataFrame([r + (1, 2, 3, "x", 4) for r in rows], names).repartition(4)


@pytest.mark.parametrize("sizes", [{}, {"first_rows": 5, "shard_rows": 20, "sample": 50, "codewords": 8}])
def test_equals_brute_force(spark, sizes):
    rng = np.random.default_rng(5)
    middle = rng.normal(size=(6, 9))
    rows = [(i, int(rng.integers(0, 4)), [float(x) for x in middle[i % 6] + 0.3 * rng.normal(size=9)]) for i in range(400)]
    rows += [(1000 + i, i % 4, [float(x) for x in rng.integers(-2, 3, 9) / 256]) for i in range(300)]  # many ties
    rows += [(2000, 1, None), (2050, 1, [0.0] * 8 + [None]), (2100, None, [1.0] * 9), (None, 1, [1.0] * 9),
             (2150, 1, [NAN] + [1.0] * 8), (2200, 1, [INF] + [1.0] * 8), (2250, 2, [0.0] * 9), (50, 2, [0.1] * 9),
             (50, 2, [0.1] * 9), (3000, 1, [0.5, 0.25]), (3001, 1, [0.5, 0.3]), (3002, 0, [0.4, 0.2]), (3050, 0, [])]
    assert found(H.hard_negatives(frame(spark, rows), **sizes)) == brute(rows)


def test_hot_vector(spark):
    rng = np.random.default_rng(6)
    rows = [(i, i % 3, [0.5, 0.25, 0.125, 0.5] if i % 2 else [float(x) for x in rng.normal(size=4)]) for i in range(600)]
    got = found(H.hard_negatives(frame(spark, rows), every=10, shard_rows=50, first_rows=20, low=40, high=120))
    assert got == brute(rows, every=10, low=40, high=120)


def test_products_beyond_doubles(spark):
    rng = np.random.default_rng(7)
    rows = [(i, i % 2, [float(x) for x in rng.integers(-2 ** 22, 2 ** 22, 3) + rng.integers(0, 256, 3) / 256])
            for i in range(120)]
    assert found(H.hard_negatives(frame(spark, rows), every=10)) == brute(rows, every=10)


def test_bounds_hold_and_the_heap_falls():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(500, 7)) * 256
    words = H.fit(x[:, :3], 6), H.fit(x[:, 3:], 6)
    c1, c2 = H.nearest(x[:, :3], words[0]), H.nearest(x[:, 3:], words[1])
    d1, d2 = H.norms(x[:, :3] - words[0][c1]), H.norms(x[:, 3:] - words[1][c2])
    cells = [(a, b, int(m.sum()), d1[m].max(), d2[m].max()) for a in range(6) for b in range(6)
             if (m := (c1 == a) & (c2 == b)).any()]
    d = H.Directory(words, cells)
    for q in x[:20]:
        upper, most, least = d.bounds(q)
        score = x @ q
        assert (score <= most[c1, c2]).all() and (score >= least[c1, c2]).all()
        order = list(d.visit(upper))
        assert len({o[1:] for o in order}) == 36
        assert all(a[0] >= b[0] for a, b in zip(order, order[1:]))
        assert all(bound >= most[a, b] - 1e-6 for bound, a, b in order if d.count[a, b])
        near = d.cells(q, [int(np.sort(score)[-5])], [2 ** 62], False, 0)
        assert set(zip(c1[np.argsort(score)[-5:]], c2[np.argsort(score)[-5:]])) <= set(near)
        assert set(d.cells(q, [0], [10], True, 60)).isdisjoint(d.cells(q, [3], [10], False, 60))


def test_labels_and_empty(spark):
    df = spark.createDataFrame([(7, 9), (8, 9), (14, 3)], "vec_id long, label int")
    assert [r[0] for r in df.select(H.relabelled(df["label"], df["vec_id"])).collect()] == [0, 9, 4]
    empty = frame(spark, [(50, 1, [1.0])])
    assert H.hard_negatives(empty.filter("false")).collect() == []
    assert H.hard_negatives(empty).collect() == []
