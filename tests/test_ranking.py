"""Property tests: distributed ranking equals Spark's single-partition window functions."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskmart.operators.ranking import dist_ntile, dist_percent_rank, dist_row_number


def _data(spark, n, distinct, null_share, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        v = None if rnd.random() < null_share else float(rnd.randrange(max(distinct, 1)))
        rows.append((i, v))
    return spark.createDataFrame(rows, "id long, v double")


CASES = [(0, 3, 0.0), (1, 1, 0.0), (2, 1, 0.5), (3, 2, 0.0), (4, 4, 0.0), (5, 2, 0.2),
         (7, 3, 0.0), (10, 1, 0.0), (101, 5, 0.1), (2000, 7, 0.05), (3000, 3000, 0.0)]


def _order(ascending):
    return [F.col("v").asc_nulls_last() if ascending else F.col("v").desc_nulls_last(), F.col("id").asc()]


@pytest.mark.parametrize("n,distinct,nulls", CASES)
@pytest.mark.parametrize("ascending", [True, False])
def test_ntile_matches_window(spark, n, distinct, nulls, ascending):
    df = _data(spark, n, distinct, nulls, seed=n * 31)
    got = df.withColumn("q", dist_ntile(df, 4, "v", "id", ascending))
    exp = df.withColumn("q_exp", F.ntile(4).over(Window.orderBy(*_order(ascending))))
    assert got.count() == n
    assert got.join(exp, "id").where(F.col("q") != F.col("q_exp")).count() == 0


@pytest.mark.parametrize("n,distinct,nulls", CASES)
@pytest.mark.parametrize("ascending", [True, False])
def test_percent_rank_matches_window(spark, n, distinct, nulls, ascending):
    df = _data(spark, n, distinct, nulls, seed=n * 17)
    got = dist_percent_rank(df, "v", "pr", ascending)
    exp = df.withColumn("pr_exp", F.percent_rank().over(Window.orderBy(_order(ascending)[0])))
    assert got.count() == n
    assert got.join(exp, "id").where(F.col("pr") != F.col("pr_exp")).count() == 0


def test_nan_and_null_are_values_of_their_own(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, float("nan")), (4, None)], "id long, v double")
    got = {r["id"]: (r["pr"], r["q"]) for r in dist_percent_rank(df, "v", "pr").withColumn(
        "q", dist_ntile(df, 4, "v", "id")).collect()}
    assert got == {1: (0.0, 1), 2: (1 / 3, 2), 3: (2 / 3, 3), 4: (1.0, 4)}


@pytest.mark.parametrize("ascending", [True, False])
def test_hot_value_over_many_ranges(spark, ascending):
    rows = [(i, 7.0 if i % 3 == 0 else float(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, v double").repartition(16)
    exp = df.select("id", F.ntile(4).over(Window.orderBy(*_order(ascending))).alias("q_exp"),
                    F.row_number().over(Window.orderBy(*_order(ascending))).alias("rn_exp"))
    got = df.withColumn("q", dist_ntile(df, 4, "v", "id", ascending))
    assert got.join(exp, "id").where(F.col("q") != F.col("q_exp")).count() == 0
    rn = dist_row_number(df, _order(ascending))
    assert rn.join(exp, "id").where(F.col("_rn") != F.col("rn_exp")).count() == 0


def test_tile_is_assigned_without_a_join(spark):
    df = _data(spark, 200, 9, 0.1, seed=5)
    plan = df.withColumn("q", dist_ntile(df, 4, "v", "id"))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("ascending", [True, False])
def test_percent_rank_of_hot_values_over_many_ranges(spark, ascending):
    """Runs that fill whole ranges, begin or end inside of one; no exchange is keyed by the value."""
    value = lambda i: None if i % 50 == 0 else 7.0 if i % 2 else 9.0 if i % 3 == 0 else float(i % 400)
    df = spark.createDataFrame([(i, value(i)) for i in range(2000)], "id long, v double").repartition(16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        got = dist_percent_rank(df, "v", "pr", ascending, id_col="id")
        exp = df.select("id", F.percent_rank().over(Window.orderBy(_order(ascending)[0])).alias("pr_exp"))
        assert got.columns == ["id", "v", "pr"] and got.count() == 2000
        assert got.join(exp, "id").where(F.col("pr") != F.col("pr_exp")).count() == 0
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(v#" not in plan
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
