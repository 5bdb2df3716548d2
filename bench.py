"""Benchmark: the full layered run at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Setup (untimed): the driver tables are mapped onto the six native credit tables and written as
Parquet, the same shape of input the reference's transformation run starts from.

Timed, in order:
* ``pipeline``   — source check, 6 staging views, 4 intermediate + 5 mart tables written, the
  120 data tests gating each layer, and the quality report (the reference's "15 models" run);
* ``reports``    — every named report query over the written tables;
* ``ml``         — feature table + training and evaluation of the two default-prediction models.

Prints one JSON line: {"metric": "pipeline_sec", "value": ..., "unit": "sec", "queries": {...}, "sf": ...}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from concurrent.futures import ThreadPoolExecutor

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskmart import pipeline, snapshots  # noqa: E402
from riskmart.session import build_session  # noqa: E402
from riskmart.sources import fixtures  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus, 8), app_name="riskmart-bench",
                          extra={"spark.driver.memory": "16g", "spark.sql.autoBroadcastJoinThreshold": "16m"})
    scratch = tempfile.mkdtemp(prefix="riskmart-bench-")
    src = f"{scratch}/src"
    for name, df in fixtures.fixture_sources(spark, sf_dir).items():
        df.write.mode("overwrite").parquet(f"{src}/{name}.parquet")

    timings: dict[str, float] = {}
    t0 = time.perf_counter()
    res = pipeline.run(spark, f"{scratch}/out", src_dir=src, as_of=fixtures.AS_OF)
    timings["pipeline"] = round(time.perf_counter() - t0, 3)
    timings.update({f"pipeline.{k}": v for k, v in res.timings.items()})

    from riskmart.plans import reports

    marts = {n: snapshots.read_published(spark, f"{scratch}/out", "marts", n) for n in pipeline.MARTS}
    inter = {n: snapshots.read_published(spark, f"{scratch}/out", "intermediate", n) for n in pipeline.INTERMEDIATE}
    stg = res.tables
    score, port, ltv = marts["fct_credit_score"], marts["fct_portfolio_health"], marts["fct_customer_ltv"]
    coll, seg = marts["fct_collection_efficiency"], marts["fct_risk_segments"]
    acq, perf = inter["int_acquisition_quality"], inter["int_payment_performance"]
    since, min_c = fixtures.REPORT_SINCE, fixtures.MIN_MONTH_CONTRACTS
    report_jobs = {
        "portfolio_kpis": lambda: reports.portfolio_kpis(stg["stg_contracts"]),
        "default_rate": lambda: reports.default_rate(port, since),
        "ltv_summary": lambda: reports.ltv_summary(ltv),
        "product_risk": lambda: reports.product_risk(perf),
        "score_dist_detail": lambda: reports.score_dist_detail(score),
        "score_distribution": lambda: reports.score_distribution(score),
        "risk_tier_summary": lambda: reports.risk_tier_summary(score),
        "vintage_analysis": lambda: reports.vintage_analysis(stg["stg_contracts"]),
        "rfm_overview": lambda: reports.rfm_overview(seg),
        "digital_by_segment": lambda: reports.digital_by_segment(seg, inter["int_customer_digital_behavior"]),
        "header_kpis": lambda: reports.header_kpis(score, port, min_c),
        "score_histogram": lambda: reports.score_histogram(score),
        "channel_by_ltv": lambda: reports.channel_by_ltv(acq),
        "best_collection_window": lambda: reports.best_collection_window(coll),
    }
    # the report queries are independent reads of the written tables (a dashboard refresh):
    # they are submitted concurrently; per-query numbers are latencies under that load
    def run_report(item):
        name, job = item
        ts = time.perf_counter()
        job().collect()
        return name, round(time.perf_counter() - ts, 3)

    t1 = time.perf_counter()
    with ThreadPoolExecutor(max_workers=4) as pool:
        for name, secs in pool.map(run_report, report_jobs.items()):
            timings[f"report.{name}"] = secs
    timings["reports"] = round(time.perf_counter() - t1, 3)

    from riskmart.learn import train
    from riskmart.plans import features

    t2 = time.perf_counter()
    feats = features.default_features(stg, fixtures.ML_CUTOFF, fixtures.ML_LABEL_END, fixtures.ML_RECENT_START,
                                      fixtures.ML_EVENT_START, fixtures.ML_EVENT_END).cache()
    feats.count()
    timings["ml.features"] = round(time.perf_counter() - t2, 3)
    results, _ = train.train_default_models(feats, features.DEFAULT_NUMERIC, features.CATEGORICAL)
    timings["ml"] = round(time.perf_counter() - t2, 3)

    rows = {n: spark.read.parquet(f"{src}/{n}.parquet").count() for n in
            ["customers", "contracts", "payments", "app_events", "proposals", "collections"]}
    out = {
        "metric": "pipeline_sec",
        "value": timings["pipeline"],
        "unit": "sec",
        "queries": timings,
        "sf": sf,
        "source_rows": sum(rows.values()),
        "rows_per_sec": round(sum(rows.values()) / timings["pipeline"], 1),
        "best_model": {"name": results[0].name, **{k: round(v, 4) for k, v in results[0].metrics.items()}},
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
