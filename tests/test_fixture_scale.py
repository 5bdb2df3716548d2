"""Payments meet their contracts in tasks of bounded size: more rows make more tasks, and the same result."""

from pyspark.sql import functions as F

from driver_data import SF001
from riskmart.operators import quality
from riskmart.plans import intermediate, staging
from riskmart.sources import fixtures

N = 400


def _tables(spark):
    k = F.col("id")
    orders = spark.range(N).select(
        k.alias("o_orderkey"), (k % 90).alias("o_custkey"), F.lit("2-HIGH").alias("o_orderpriority"),
        F.date_add(F.lit("2000-01-01").cast("date"), (k % 300).cast("int")).cast("timestamp_ntz").alias("o_orderdate"),
        (k * 1.25).alias("o_totalprice"))
    lineitem = spark.range(4 * N).select(
        (k % N).alias("l_orderkey"), (k % 4).cast("int").alias("l_linenumber"), k.alias("l_partkey"),
        (k % 7).alias("l_suppkey"), F.lit(2.0).alias("l_quantity"), (k * 0.5).alias("l_extendedprice"),
        (k % 10 / 100).alias("l_discount"), F.when(k % 3 == 0, "R").when(k % 3 == 1, "A").otherwise("N").alias("l_returnflag"),
        F.date_add(F.lit("2000-03-01").cast("date"), (k % 200).cast("int")).cast("timestamp_ntz").alias("l_shipdate"))
    return {"orders": orders, "lineitem": lineitem}


def _performance(spark, t):
    stg = staging.stg_payments(fixtures.payments(t)), staging.stg_contracts(fixtures.contracts(t), fixtures.AS_OF)
    return sorted(map(str, intermediate.int_payment_performance(*stg).collect()))


def test_payments_are_dealt_over_tasks_by_their_number(spark, monkeypatch):
    t = _tables(spark)
    whole = _performance(spark, t)
    monkeypatch.setattr(fixtures, "TASK_ROWS", 100)
    dealt = fixtures.payments(t)
    assert dealt.count() == 4 * N
    assert dealt.rdd.getNumPartitions() >= 4 * N // 100
    assert _performance(spark, t) == whole


def test_many_payments_meet_their_contracts_without_a_sort(spark, monkeypatch):
    t = _tables(spark)
    t["orders"] = t["orders"].union(t["orders"].limit(3))  # keys may repeat
    rows = sorted(map(str, fixtures.payments(t).collect()))
    assert len(rows) == 4 * N + 3 * 4
    monkeypatch.setattr(fixtures, "TASK_ROWS", 100)
    dealt = fixtures.payments(t)
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Sort " not in plan
    assert sorted(map(str, dealt.collect())) == rows


def test_more_orders_than_payments_make_more_tasks(spark, monkeypatch):
    t = _tables(spark)
    t["lineitem"] = t["lineitem"].limit(90)
    rows = sorted(map(str, fixtures.payments(t).collect()))
    monkeypatch.setattr(fixtures, "TASK_ROWS", 100)
    dealt = fixtures.payments(t)
    assert dealt.rdd.getNumPartitions() == N // 100
    assert sorted(map(str, dealt.collect())) == rows


def test_keys_of_large_models_are_counted_in_tasks_of_bounded_size(spark, monkeypatch):
    keys = spark.range(1000).select((F.col("id") % 990).alias("k")).union(spark.range(5).select(F.lit(None).cast("long")))
    hashes = keys.select(F.xxhash64("k").alias("_hash"))
    assert quality.repeated_keys(keys, "k") == 10
    monkeypatch.setattr(quality, "KEY_ROWS", 50)
    assert quality._dealt(hashes, 1005).rdd.getNumPartitions() == 21
    assert quality._dealt(hashes, None) is hashes
    assert quality.repeated_keys(keys, "k", rows=1005) == 10
    assert quality.repeated_keys(keys, "k", hash_of=lambda c: c % 7, rows=1005) == 10


def test_every_staging_model_has_its_rows(spark):
    counts = fixtures.fixture_rows(spark, SF001)
    stg = staging.build_staging(fixtures.fixture_sources(spark, SF001), fixtures.AS_OF)
    assert set(counts) == set(stg)
    assert all(stg[m].count() <= n for m, n in counts.items())
