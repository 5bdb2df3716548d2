"""Data tests catch seeded violations; the layered run writes every layer and stops at a failing gate."""

import os
import tempfile
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from driver_data import SF001
from riskmart import pipeline, snapshots
from riskmart.operators import quality
from riskmart.plans import staging
from riskmart.sources import fixtures


def test_catalogue_has_120_checks():
    assert quality.count_checks() == 120
    per_layer = {}
    for t in quality.CATALOGUE.values():
        n = len(t.not_null) + len(t.unique) + len(t.accepted_values) + len(t.relationships)
        per_layer[t.layer] = per_layer.get(t.layer, 0) + n
    assert per_layer == {"staging": 60, "intermediate": 23, "marts": 37}


def test_seeded_violations_are_counted(spark):
    src = fixtures.fixture_sources(spark, SF001)
    cust = pipeline.with_audit(staging.stg_customers(src["customers"], fixtures.AS_OF))
    one = cust.limit(1)
    bad = (cust.unionByName(one)                                                      # duplicate key
               .unionByName(one.withColumn("customer_id", F.lit(-5).cast("long"))
                               .withColumn("age_group", F.lit(None).cast("string"))    # null
                               .withColumn("acquisition_channel", F.lit("tv"))))       # not accepted
    contracts = staging.stg_contracts(src["contracts"], fixtures.AS_OF)
    orphan = contracts.limit(2).withColumn("customer_id", F.lit(-77).cast("long"))      # 2 orphan rows
    res = quality.run_checks({"stg_customers": bad, "stg_contracts": contracts.unionByName(orphan)})
    got = {(r["model"], r["column_name"], r["test"]): r["failures"] for r in res.collect()}
    assert len(got) == 11 + 11  # stg_customers 7+1+3, stg_contracts 6+1+3+1
    assert got[("stg_customers", "customer_id", "unique")] == 1
    assert got[("stg_customers", "age_group", "not_null")] == 1
    assert got[("stg_customers", "acquisition_channel", "accepted_values")] == 1
    assert got[("stg_contracts", "customer_id", "relationships")] == 2
    assert got[("stg_contracts", "contract_id", "unique")] == 2
    assert got[("stg_customers", "_loaded_at", "not_null")] == 0
    with pytest.raises(quality.QualityGateError) as err:
        quality.gate(res, "staging")
    assert err.value.layer == "staging" and len(err.value.failures) == 5


def test_pipeline_writes_layers_and_passes_all_gates(spark):
    out = tempfile.mkdtemp(prefix="riskmart-test-run-")
    src = fixtures.fixture_sources(spark, SF001)
    res = pipeline.run(spark, out, sources=src, as_of=fixtures.AS_OF)
    checks = res.checks.collect()
    assert len(checks) == 120 and all(r["failures"] == 0 for r in checks)
    for layer, names in [("intermediate", pipeline.INTERMEDIATE), ("marts", pipeline.MARTS)]:
        for n in names:
            df = snapshots.read_published(spark, out, layer, n)
            assert "_loaded_at" in df.columns and df.count() > 0
    rep = {r["source"]: r for r in snapshots.read_published(spark, out, "reports", "quality_report", "json").collect()}
    assert set(rep) == {"customers", "payments", "contracts"}
    assert rep["payments"]["n"] == src["payments"].count()


def test_failing_staging_gate_stops_the_run(spark):
    out = tempfile.mkdtemp(prefix="riskmart-test-gate-")
    src = dict(fixtures.fixture_sources(spark, SF001))
    src["payments"] = src["payments"].withColumn(
        "payment_method", F.when(F.col("days_late") > 40, F.lit("cash")).otherwise(F.col("payment_method")))
    with pytest.raises(quality.QualityGateError) as err:
        pipeline.run(spark, out, sources=src, as_of=fixtures.AS_OF)
    assert ("stg_payments", "payment_method", "accepted_values", 1) in err.value.failures
    assert snapshots.current(spark, out) is None
    assert not os.path.exists(f"{snapshots.version_path(out, 1)}/intermediate")


def test_source_validation_reports_missing_tables(spark):
    from riskmart.sources.readers import MissingSourceError, validate_sources

    d = tempfile.mkdtemp(prefix="riskmart-test-src-")
    spark.range(3).write.parquet(f"{d}/customers.parquet")
    with pytest.raises(MissingSourceError) as err:
        validate_sources(spark, d)
    assert "contracts" in str(err.value) and "customers" not in str(err.value).split("[")[1]


def test_pipeline_tables_equal_registry_models(spark):
    """The written layers hold exactly what the (oracle-checked) registry models compute."""
    from riskmart.registry import layers

    out = tempfile.mkdtemp(prefix="riskmart-test-same-")
    pipeline.run(spark, out, sources=fixtures.fixture_sources(spark, SF001), as_of=fixtures.AS_OF, gate=False)
    l = layers(spark, SF001)
    models = {**{n: ("intermediate", l.int[n]) for n in pipeline.INTERMEDIATE},
              **{n: ("marts", l.mart[n]) for n in pipeline.MARTS}}
    for name, (layer, df) in models.items():
        written = snapshots.read_published(spark, out, layer, name).drop("_loaded_at").select(*df.columns)
        assert written.count() == df.count(), name
        assert written.exceptAll(df).count() == 0 and df.exceptAll(written).count() == 0, name


def test_a_failed_or_killed_run_leaves_the_published_version(spark, monkeypatch):
    out = tempfile.mkdtemp(prefix="riskmart-test-publish-")
    src = fixtures.fixture_sources(spark, SF001)
    first = pipeline.run(spark, out, sources=src, as_of=fixtures.AS_OF)
    seen = snapshots.read_published(spark, out, "marts", "fct_risk_segments")
    before = sorted(map(tuple, seen.collect()))
    assert first.version == snapshots.current(spark, out) == 1

    class Killed(BaseException):
        pass

    whole = pipeline.write_table

    def half_way(df, path, fmt="parquet"):
        if path.endswith("fct_customer_ltv"):  # some marts are written, this one in part
            df.limit(3).write.mode("overwrite").parquet(path)
            raise Killed
        whole(df, path, fmt)

    with monkeypatch.context() as m:
        m.setattr(pipeline, "write_table", half_way)
        with pytest.raises(Killed):
            pipeline.run(spark, out, sources=src, as_of=fixtures.AS_OF)
    assert snapshots.current(spark, out) == 1
    # a mart test fails: its segment names are no longer the accepted ones
    with monkeypatch.context() as m:
        real = pipeline.marts.fct_risk_segments
        m.setattr(pipeline.marts, "fct_risk_segments", lambda *a: real(*a).withColumn("segment", F.lit("unknown")))
        with pytest.raises(quality.QualityGateError) as err:
            pipeline.run(spark, out, sources=src, as_of=fixtures.AS_OF)
        assert ("fct_risk_segments", "segment", "accepted_values", 1) in err.value.failures
    assert snapshots.current(spark, out) == 1
    assert sorted(map(tuple, snapshots.read_published(spark, out, "marts", "fct_risk_segments").collect())) == before
    assert snapshots.publish(spark, out, 4) and not snapshots.publish(spark, out, 3)  # an older run comes too late
    assert snapshots.current(spark, out) == 4


def test_numbers_are_claimed_once(spark):
    folder = tempfile.mkdtemp(prefix="riskmart-test-claims-") + "/claims"
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda _: snapshots.claim_number(spark, folder), range(24)))
    assert sorted(got) == list(range(1, 25))
    assert snapshots.claim_number(spark, folder, above=40) == 41


def test_unique_counts_keys_whose_hashes_collide(spark):
    df = spark.createDataFrame([(f"k{i}",) for i in range(90)] + [("k3",), ("k3",), ("k50",), (None,), (None,)], "key string")
    assert quality.repeated_keys(df, "key") == 2
    few = lambda c: F.length(c)  # noqa: E731  two different hashes only
    assert quality.repeated_keys(df, "key", few) == 2
    assert quality.repeated_keys(df.dropDuplicates(), "key", few) == 0
    plan = df.select(F.xxhash64("key").alias("h")).groupBy("h").count()._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(key" not in plan


def test_tests_of_a_written_table_are_counted_by_its_write(spark):
    """One job writes and counts; values that are not accepted are then counted distinct."""
    path = tempfile.mkdtemp(prefix="riskmart-test-watch-") + "/t"
    tests = quality.ModelTests("marts", not_null=("a", "b"), accepted_values={"b": ("x", "y")})
    df = spark.createDataFrame([(1, "x"), (None, "q"), (3, None), (None, "q"), (5, "r")], "a int, b string")
    w = quality.Watch("m", df, tests)
    pipeline.write_table(w.frame, path)
    got = {(c, t): n for _, _, c, t, n in w.results(spark.read.parquet(path), {})}
    assert got == {("a", "not_null"): 2, ("b", "not_null"): 1, ("b", "accepted_values"): 2}
    empty = quality.Watch("m", df.where("false"), tests)
    assert all(n == 0 for *_, n in empty.results(df.where("false"), {}, passed=False))
