"""Exact selection equals sorting: many rounds, ties, nulls, NaN, strings, hot values, repeated rows."""

import random

import pytest
from pyspark.sql import functions as F

from riskmart.operators import selection
from riskmart.operators.ranking import dist_ntile
from riskmart.operators.selection import select_places


def _sorted(rows, ascending):
    def key(r):
        v, i = r
        nan = v is not None and v != v
        if v is None:
            return (2, 0, i)
        if nan:
            return (1, 0, i) if ascending else (-1, 0, i)
        return (0, v if ascending else -v, i)
    return sorted(rows, key=key)


def _same(a, b):
    return a == b or (a != a and b != b)


@pytest.mark.parametrize("case,ascending", [("spread", True), ("hot", False), ("nan", True), ("nan", False), ("one", True)])
def test_places_equal_a_sort(spark, case, ascending):
    r = random.Random(case)
    n = 1 if case == "one" else 1500
    value = {"spread": lambda i: r.random() * 1000 - 500, "hot": lambda i: 7.0 if i % 2 else float(r.randrange(3000)), "one": lambda i: 1.0,
             "nan": lambda i: r.choice([None, float("nan"), float("inf"), -0.0, 0.0, r.random()])}[case]
    rows = [(value(i), i * 7 % 10007) for i in range(n)]
    df = spark.createDataFrame(rows, "v double, id long").repartition(5)
    places = [1, n // 2, n, n + 1, 0]
    want = _sorted(rows, ascending)
    # small samples and limits: several rounds
    got = select_places(df, places, "v", "id", ascending, sample=400, limit=100)
    assert set(got) == {p for p in places if 1 <= p <= n}
    for p, row in got.items():
        assert _same(row["v"], want[p - 1][0]) and row["id"] == want[p - 1][1], p


def test_kinds_of_values_and_ids(spark):
    r = random.Random(4)
    rows = [(f"{r.getrandbits(64):016x}"[:r.randrange(1, 16)] + "é" * (i % 3), f"id-{i:05d}", r.randrange(-2**40, 2**40))
            for i in range(600)]
    df = spark.createDataFrame(rows, "h string, id string, n long")
    by_text = sorted((h.encode(), i) for h, i, _ in rows)
    got = select_places(df, [1, 299, 600], "h", "id", sample=200, limit=150)
    assert [(got[p]["h"].encode(), got[p]["id"]) for p in (1, 299, 600)] == [by_text[p - 1] for p in (1, 299, 600)]
    by_number = sorted((-n, i) for _, i, n in rows)
    got = select_places(df, [5, 300], "n", "id", ascending=False, sample=200, limit=150)
    assert [(-got[p]["n"], got[p]["id"]) for p in (5, 300)] == [by_number[p - 1] for p in (5, 300)]
    money = df.select("id", (F.col("n") / 100).cast("decimal(20,2)").alias("n"))
    got = select_places(money, [5], "n", "id", ascending=False)
    assert got[5]["id"] == by_number[4][1]


def test_equal_rows_end_the_search(spark):
    df = spark.createDataFrame([(1.0, 1)] * 500 + [(2.0, 2)] * 500, "v double, id long")
    got = select_places(df, [1, 500, 501, 1000], "v", "id", sample=50, limit=40)
    assert [got[p]["v"] for p in (1, 500, 501, 1000)] == [1.0, 1.0, 2.0, 2.0]


def test_a_wrong_bracket_is_left_again(spark, monkeypatch):
    """Counts decide: a bracket that misses its place is left for the part below or above it."""
    rows = [(float(i * 37 % 1009), i) for i in range(1009)]
    df = spark.createDataFrame(rows, "v double, id long")
    true, shift = selection._around, iter([-0.4, 0.4] * 50)

    def wrong(bracket, place, keys):
        s = next(shift)
        return true(bracket, min(max(place + int(s * bracket.size), bracket.below + 1), bracket.below + bracket.size), keys)

    monkeypatch.setattr(selection, "_around", wrong)
    got = select_places(df, [505], "v", "id", sample=300, limit=200)
    assert got[505]["v"] == 504.0


def test_empty_and_no_sort_of_the_table(spark):
    df = spark.createDataFrame([], "v double, id long")
    assert select_places(df, [1], "v", "id") == {}
    few = spark.createDataFrame([(3.0, 1), (1.0, 2)], "v double, id long")
    tiles = {r["id"]: r["q"] for r in few.withColumn("q", dist_ntile(few, 4, "v", "id")).collect()}
    assert tiles == {2: 1, 1: 2}
