"""Sources laid out by customer: same results, no exchange of payments, hot customers kept out."""

import re
import tempfile

import pytest
from pyspark.sql import functions as F

from driver_data import SF001
from riskmart import pipeline
from riskmart.plans import features, intermediate, staging
from riskmart.snapshots import read_published
from riskmart.sources import bucketed, fixtures
from riskmart.sources.schemas import column_names

BUCKETS = 8


@pytest.fixture(scope="module")
def written(spark):
    sources = {n: df.select(*column_names(n)) for n, df in fixtures.fixture_sources(spark, SF001).items()}
    root = tempfile.mkdtemp(prefix="riskmart-bucketed-") + "/it's"
    layout = bucketed.write_bucketed(spark, sources, root, BUCKETS)
    return sources, root, layout


def exchanged_inputs(df):
    """Number of exchanges by hash, and the bucketed scans, in the plan before it runs."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Exchange hashpartitioning", plan)), len(re.findall(r"Bucketed: true", plan))


def test_rows_come_back(spark, written):
    sources, root, layout = written
    found = bucketed.read_bucketed(spark, root)
    assert set(found) == set(sources)
    assert layout["payments"] == layout["contracts"] == layout["customers"] == BUCKETS
    for name, df in sources.items():
        got = found[name].select(df.columns)
        assert got.count() == df.count() and got.exceptAll(df).count() == 0


def test_models_do_not_shuffle_payments(spark, written):
    """Profile, payments per customer and features are computed where the rows lie; plain sources need exchanges."""
    sources, root, _ = written
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # joins that small tables would hide
    try:
        plans = {}
        for kind, src in (("plain", sources), ("bucketed", bucketed.read_bucketed(spark, root))):
            stg = staging.build_staging(src, fixtures.AS_OF)
            plans[kind] = {
                "payment facts": intermediate.customer_payment_facts(stg["stg_payments"], fixtures.AS_OF),
                "profile": intermediate.int_customer_credit_profile(
                    stg["stg_customers"], stg["stg_contracts"], stg["stg_payments"], fixtures.AS_OF),
                "features": features.default_features(
                    stg, fixtures.ML_CUTOFF, fixtures.ML_LABEL_END, fixtures.ML_RECENT_START, fixtures.ML_EVENT_START,
                    fixtures.ML_EVENT_END)}
        counts = {kind: {n: exchanged_inputs(df) for n, df in found.items()} for kind, found in plans.items()}
        assert counts["bucketed"]["payment facts"] == (0, 1)
        # (the contracts' first step groups by customer and product, which the buckets satisfy)
        assert counts["bucketed"]["profile"] == (0, 3)
        assert counts["bucketed"]["features"][0] < counts["plain"]["features"][0]
        assert all(n > 0 and scans == 0 for n, scans in counts["plain"].values())
        for name, df in plans["plain"].items():
            assert df.exceptAll(plans["bucketed"][name]).count() == 0
            assert df.count() == plans["bucketed"][name].count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_run_on_bucketed_sources(spark, written):
    sources, root, _ = written
    outs = {}
    for kind, src in (("plain", sources), ("bucketed", bucketed.read_bucketed(spark, root))):
        outs[kind] = tempfile.mkdtemp(prefix="riskmart-bucketed-out-")
        pipeline.run(spark, outs[kind], sources=src, as_of=fixtures.AS_OF, gate=False)
    for layer, names in (("intermediate", pipeline.INTERMEDIATE), ("marts", pipeline.MARTS)):
        for name in names:
            a, b = (read_published(spark, outs[k], layer, name).drop("_loaded_at") for k in ("plain", "bucketed"))
            assert a.count() == b.count() and a.exceptAll(b).count() == 0, name


def test_hot_customer_stays_plain(spark):
    n = 4000
    pays = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).cast("long").alias("customer_id"), "id")
    root = tempfile.mkdtemp(prefix="riskmart-hot-") + "/src"
    nothing = spark.range(0).select(F.col("id").alias("customer_id"))
    unkeyed = spark.range(5)
    blank = spark.range(n).select(F.when(F.col("id") % 50 > 0, F.col("id")).alias("customer_id"))
    layout = bucketed.write_bucketed(spark, {"hot": pays, "nothing": nothing, "unkeyed": unkeyed, "blank": blank}, root, 64)
    assert layout == {"hot": 0, "nothing": 0, "unkeyed": 0, "blank": 64}
    assert spark.read.parquet(f"{root}/hot").count() == n
    assert spark.read.parquet(f"{root}/blank").filter("customer_id is null").count() == n // 50
    assert bucketed.largest_share(pays, 64) > 64 / 3
