"""End-to-end training jobs: features -> models -> artefacts and records.

``default_job`` trains the future-default models (logistic + forest, overfit guard, best by
F1), saves the chosen ``PipelineModel`` and its preprocessing, writes the metrics JSON, the
per-class report and the attribution (a forest's importances if a forest wins),
and appends a run record and a model version.  ``alert_job`` does the same for the forest on
the score mart's ``alert_30d`` label and also writes the forest importances as CSV.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.learn import train
from riskmart.plans import features
from riskmart.session import checkpoint_table


@dataclass
class JobResult:
    best: train.Trained
    run_id: str
    version: int
    model_path: str


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Read a metrics file written by a job (A5)."""
    return spark.read.json(path)


def default_job(spark: SparkSession, feature_table: DataFrame, out_dir: str, model_name: str = "credit_default",
                cutoff: dt.date = features.CUTOFF, label_end: dt.date = features.LABEL_END,
                guard_auc: float = 0.90) -> JobResult:
    """``cutoff`` and ``label_end`` are those that ``feature_table`` was built with; they go into the metrics file."""
    out = out_dir.rstrip("/")
    num, cat = features.DEFAULT_NUMERIC, features.CATEGORICAL
    feature_table = checkpoint_table(feature_table, "riskmart-features")
    results, test = train.train_default_models(feature_table, num, cat, guard_auc=guard_auc)
    best = results[0]
    model_path = f"{out}/models/{model_name}"
    train.save_model(best.model, model_path)
    train.save_model(PipelineModel(stages=best.model.stages[:-1]), f"{out}/models/{model_name}_preprocessing")
    counts = feature_table.agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("target").cast("double")).alias("rate")).first()
    n_test = test.count()
    attribution = train.top_features(best, test, num, cat).orderBy(F.col("importance").desc(), "feature")
    attribution = checkpoint_table(attribution, "riskmart-attribution")  # a row per feature
    attribution.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{out}/attribution")
    top = attribution.orderBy(F.col("importance").desc(), "feature").limit(10).collect()
    report = train.class_report(best.model.transform(test))
    report.coalesce(1).write.mode("overwrite").json(f"{out}/class_report")
    first_label_day = cutoff + dt.timedelta(days=1)
    extra = {"train_samples": int(counts["n"] - n_test), "test_samples": int(n_test),
             "target_positive_rate": round(float(counts["rate"] or 0.0), 4),
             "top_features": [{"feature": r["feature"], "importance": round(r["importance"], 4)} for r in top],
             # features end at the cut-off and the label starts after it
             "leakage_corrected": True, "cutoff_date": cutoff.isoformat(),
             "target_window": f"{first_label_day.isoformat()} to {label_end.isoformat()}"}
    test.unpersist()
    train.write_metrics_json(spark, best, extra, f"{out}/model_metrics")
    run_id = train.log_run(spark, f"{out}/ml_runs", best.name, {**best.params, "candidates": len(results)},
                           best.metrics, {"target": "future_default"})
    version = train.register_version(spark, f"{out}/ml_model_versions", model_name, model_path, run_id)
    return JobResult(best, run_id, version, model_path)


def alert_job(spark: SparkSession, feature_table: DataFrame, out_dir: str,
              model_name: str = "credit_alert") -> JobResult:
    out = out_dir.rstrip("/")
    num, cat = features.ALERT_NUMERIC, features.CATEGORICAL
    trained, test = train.train_alert_model(feature_table, num, cat)
    model_path = f"{out}/models/{model_name}"
    train.save_model(trained.model, model_path)
    importances = train.importance_frame(spark, train.forest_importances(trained, num, cat))
    (importances.select("feature", "importance").orderBy(F.col("importance").desc())
     .coalesce(1).write.mode("overwrite").option("header", True).csv(f"{out}/feature_importances"))  # B3
    train.write_metrics_json(spark, trained, {"test_samples": int(test.count())}, f"{out}/alert_metrics")
    test.unpersist()
    run_id = train.log_run(spark, f"{out}/ml_runs", "credit_default_rf_v1", trained.params, trained.metrics,
                           {"stage": "staging", "target": "alert_30d"})
    version = train.register_version(spark, f"{out}/ml_model_versions", model_name, model_path, run_id)
    return JobResult(trained, run_id, version, model_path)
