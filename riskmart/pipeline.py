"""The layered batch run.

``run`` = validate sources -> staging views (tested) -> intermediate tables (written, tested)
-> marts (written, tested) -> run summaries -> publication.  Each materialised layer is written as
Parquet and read back, which both persists it and cuts the lineage, so the next layer starts from
files and a lost executor only recomputes from the last written layer.  A layer whose data tests
fail raises ``QualityGateError`` before anything downstream runs.

A run writes a version of its own (``riskmart.snapshots``); readers see it only after all tests
have passed, and the former version until then.
"""

from __future__ import annotations

import datetime as dt
import threading
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart import snapshots
from riskmart.operators import quality
from riskmart.plans import intermediate, marts, staging, summaries
from riskmart.session import checkpoint_table
from riskmart.sources import read_sources, validate_sources

# Layer -> models, in dependency order.
STAGING = ["stg_customers", "stg_contracts", "stg_payments", "stg_app_events", "stg_proposals",
           "stg_collections"]
INTERMEDIATE = ["int_customer_credit_profile", "int_customer_digital_behavior", "int_payment_performance",
                "int_acquisition_quality"]
MARTS = ["fct_credit_score", "fct_customer_ltv", "fct_portfolio_health", "fct_collection_efficiency",
         "fct_risk_segments"]

def with_audit(df: DataFrame, source: str | None = None) -> DataFrame:
    """Add the audit columns (B8).  Kept out of the model functions: they are not deterministic."""
    df = df.withColumn("_loaded_at", F.current_timestamp())
    if source is not None:
        df = df.withColumn("_source", F.lit(source))
    return df


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Create-or-replace a table (B2) at ``path``, written as the plan's partitions come."""
    df.write.mode("overwrite").format(fmt).save(path)


@dataclass
class RunResult:
    timings: dict[str, float] = field(default_factory=dict)
    checks: DataFrame | None = None
    tables: dict[str, DataFrame] = field(default_factory=dict)
    version: int | None = None
    path: str | None = None  # the version's folder


_LOCK = threading.Lock()


def _timed(res: RunResult, name: str, fn):
    t0 = time.perf_counter()
    out = fn()
    with _LOCK:
        res.timings[name] = round(time.perf_counter() - t0, 3)
    return out


def _parallel(jobs: dict, max_workers: int) -> dict:
    """Submit independent Spark jobs from a thread pool so their stages share the cluster.

    Models of one layer do not depend on each other; running them concurrently overlaps the
    small jobs' scheduling latency and keeps all executors busy.
    """
    with ThreadPoolExecutor(max_workers=max(1, max_workers)) as pool:
        futures = {name: pool.submit(fn) for name, fn in jobs.items()}
        return {name: f.result() for name, f in futures.items()}


def _tested(checks: DataFrame, layer: str) -> DataFrame:
    quality.gate(checks, layer)  # runs the checks; raises QualityGateError on any failure
    return checks


def run(spark: SparkSession, out_dir: str, sources: dict[str, DataFrame] | None = None,
        src_dir: str | None = None, as_of: dt.date | None = None, gate: bool = True,
        retries: int = 1, parallelism: int = 5) -> RunResult:
    """Build every layer (``staging`` views, ``intermediate`` and ``marts`` tables) as a new version in ``out_dir``.

    Pass either native ``src_dir`` Parquet files or ready ``sources`` DataFrames.  Read the tables with
    ``snapshots.read_published``.
    """
    res = RunResult()
    root = out_dir.rstrip("/")
    res.version = snapshots.begin(spark, root)
    out = res.path = snapshots.version_path(root, res.version)
    if sources is None:
        if src_dir is None:
            raise ValueError("give sources or src_dir")
        _timed(res, "validate_sources", lambda: validate_sources(spark, src_dir).collect())
        sources = _timed(res, "read_sources", lambda: read_sources(spark, src_dir))

    def attempt(name, fn):
        for i in range(retries + 1):
            try:
                return _timed(res, name, fn)
            except quality.QualityGateError:
                raise
            except Exception:  # noqa: BLE001  (task-level failures are retried by Spark itself)
                if i == retries:
                    raise

    stg = _timed(res, "build_staging", lambda: staging.build_staging(sources, as_of))
    stg_audited = {n: with_audit(df, f"{n[4:]}.parquet") for n, df in stg.items()}
    checks = []
    if gate:
        stg_checks = attempt("test_staging", lambda: _tested(quality.run_checks(stg_audited), "staging"))
        checks.append(stg_checks)

    # The credit profile and the acquisition model share one per-customer pass over contracts
    # and one over payments: the first of the two to need them computes and keeps them.
    facts: dict[str, DataFrame] = {}
    shared: dict[str, DataFrame] = {}
    facts_lock = threading.Lock()

    def materialised(df: DataFrame) -> DataFrame:
        df = df.persist()
        df.count()
        return df

    def shared_facts() -> tuple[DataFrame, DataFrame]:
        with facts_lock:
            if not facts:
                facts.update(_parallel({
                    "contracts": lambda: materialised(intermediate.customer_contract_facts(stg["stg_contracts"])),
                    "payments": lambda: materialised(
                        intermediate.customer_payment_facts(stg["stg_payments"], as_of)),
                }, 2))
            return facts["contracts"], facts["payments"]

    months_lock = threading.Lock()

    def shared_months() -> DataFrame:
        """One row per contract and month, for the payment performance and the portfolio mart."""
        with months_lock:
            if "months" not in shared:
                shared["months"] = checkpoint_table(
                    intermediate.contract_months(stg["stg_payments"], stg["stg_contracts"]), "riskmart-months")
            return shared["months"]

    def profile():
        cf, pf = shared_facts()
        return intermediate.int_customer_credit_profile(
            stg["stg_customers"], stg["stg_contracts"], stg["stg_payments"], as_of, cf, pf)

    def acquisition():
        cf, pf = shared_facts()
        return intermediate.int_acquisition_quality(
            stg["stg_customers"], stg["stg_contracts"], stg["stg_payments"], stg["stg_proposals"], cf, pf)

    # each model's plan is built inside its own worker, so plan construction overlaps execution
    inter_builders = {
        "int_customer_credit_profile": profile,
        "int_customer_digital_behavior": lambda: intermediate.int_customer_digital_behavior(
            stg["stg_customers"], stg["stg_app_events"]),
        "int_payment_performance": lambda: intermediate.int_payment_performance(
            stg["stg_payments"], stg["stg_contracts"], shared_months()),
        "int_acquisition_quality": acquisition,
    }
    schemas: dict = {}
    watches: dict[str, quality.Watch] = {}

    def build(layer, n, builder):
        df = with_audit(builder())
        schemas[n] = df.schema
        watches[n] = quality.watch(n, df)  # most data tests are counted while the table is written
        write_table(watches[n].frame, f"{out}/{layer}/{n}")

    def read_back(layer, names):
        return {n: spark.read.schema(schemas[n]).parquet(f"{out}/{layer}/{n}") for n in names}

    def tested(layer, tables):
        checked = quality.check_watched({n: watches[n] for n in tables}, tables, {**stg, **tables})
        return _tested(checked, layer)

    try:
        _parallel({n: (lambda n=n: attempt(n, lambda: build("intermediate", n, inter_builders[n])))
                   for n in INTERMEDIATE}, parallelism)
    finally:
        for df in facts.values():
            df.unpersist()
    inter = _timed(res, "read_intermediate", lambda: read_back("intermediate", INTERMEDIATE))
    if gate:
        int_checks = attempt("test_intermediate", lambda: tested("intermediate", inter))
        checks.append(int_checks)

    inter_clean = {n: df.drop("_loaded_at") for n, df in inter.items()}
    builders = {
        "fct_credit_score": lambda: marts.fct_credit_score(
            inter_clean["int_customer_credit_profile"], inter_clean["int_customer_digital_behavior"],
            stg["stg_customers"]),
        "fct_customer_ltv": lambda: marts.fct_customer_ltv(
            inter_clean["int_customer_credit_profile"], inter_clean["int_acquisition_quality"]),
        "fct_portfolio_health": lambda: marts.fct_portfolio_health(
            stg["stg_payments"], stg["stg_contracts"], shared_months()),
        "fct_collection_efficiency": lambda: marts.fct_collection_efficiency(stg["stg_collections"]),
        "fct_risk_segments": lambda: marts.fct_risk_segments(stg["stg_payments"], stg["stg_customers"], as_of),
    }
    _parallel({n: (lambda n=n: attempt(n, lambda: build("marts", n, builders[n]))) for n in MARTS}, parallelism)
    mart_tables = _timed(res, "read_marts", lambda: read_back("marts", MARTS))
    if gate:
        mart_checks = attempt("test_marts", lambda: tested("marts", mart_tables))
        checks.append(mart_checks)

    report = summaries.quality_report(stg["stg_customers"], stg["stg_payments"], stg["stg_contracts"])
    attempt("quality_report", lambda: write_table(report, f"{out}/reports/quality_report", fmt="json"))

    if checks:
        allc = checks[0]
        for c in checks[1:]:
            allc = allc.unionByName(c)
        res.checks = allc
    res.tables = {**stg, **inter, **mart_tables}
    _timed(res, "publish", lambda: snapshots.publish(spark, root, res.version))
    return res
